"""A drop that comes late, against the same drops in order."""

import random
from collections import Counter
from datetime import datetime

from pyspark.sql import functions as F

from vaultloom.operators import history


def test_splice_equals_drops_in_order(spark):
    rng = random.Random(4)
    days = [f"2024-01-0{d} 00:00:00" for d in range(1, 6)]
    for late_at in (0, 2, 4):
        # what each drop delivers, and what staging holds after it: keys stay
        drops = [{k: rng.choice("ab") for k in range(60) if rng.random() < .6} for _ in days]

        def loaded(which, drops=drops):
            state, staged = None, {}
            for i in which:
                staged = {**staged, **drops[i]}
                rows = spark.createDataFrame(sorted(staged.items()), "k int, v string").selectExpr(
                    "*", f"TIMESTAMP_NTZ'{days[i]}' AS load_dttm", f"'drop{i}' AS load_src")
                after = history.close_and_insert(state, rows, ["k"], ["v"], days[i])
                state = spark.createDataFrame(after.collect(), after.schema)
            return state

        late = spark.createDataFrame(sorted(drops[late_at].items()), "k int, v string").selectExpr(
            "*", f"TIMESTAMP_NTZ'{days[late_at]}' AS load_dttm", f"'drop{late_at}' AS load_src")
        first = {k: i for i in reversed(range(late_at + 1, len(days))) for k in drops[i]}
        later = spark.createDataFrame(
            [(k, days[i], f"drop{i}") for k, i in first.items()], "k int, ts string, seen_src string").select(
            "k", F.to_timestamp_ntz("ts").alias("seen_ts"), "seen_src")
        others = [i for i in range(len(days)) if i != late_at]
        got = history.splice(loaded(others), late, later, ["k"], ["v"], days[late_at])
        want = loaded(range(len(days)))
        assert Counter(map(tuple, got.select(*want.columns).collect())) == Counter(map(tuple, want.collect())), late_at


def test_splice_broadcasts_no_side_and_keeps_other_keys(spark):
    """Null keys meet nothing, keys that the late drop lacks stay, and all meet in one exchange."""
    history_of = "k int, v string, load_dttm timestamp_ntz, load_src string, valid_from timestamp_ntz, valid_to timestamp_ntz"
    day = {d: datetime(2024, 1, d) for d in (1, 2, 3)}
    target = spark.createDataFrame([
        (1, "a", day[1], "x", day[1], None), (2, "a", day[1], "x", day[1], None),
        (3, "b", day[1], "x", day[1], day[3]), (3, "b", day[3], "x", day[3], None),
        (None, "a", day[1], "x", day[1], None)], history_of)
    late = spark.createDataFrame(
        [(1, "b", day[2], "y"), (None, "b", day[2], "y"), (4, "b", day[2], "y")],
        "k int, v string, load_dttm timestamp_ntz, load_src string")
    later = spark.createDataFrame(
        [(1, day[3], "z"), (2, day[3], "z"), (None, day[3], "z")], "k int, seen_ts timestamp_ntz, seen_src string")
    got = history.splice(target, late, later, ["k"], ["v"], "2024-01-02 00:00:00")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert Counter(map(tuple, got.collect())) == Counter([
        (1, "a", day[1], "x", day[1], day[2]), (1, "b", day[2], "y", day[2], day[3]), (1, "a", day[3], "z", day[3], None),
        (2, "a", day[1], "x", day[1], None), (3, "b", day[1], "x", day[1], day[3]), (3, "b", day[3], "x", day[3], None),
        (4, "b", day[2], "y", day[2], None), (None, "a", day[1], "x", day[1], None), (None, "b", day[2], "y", day[2], None)])
