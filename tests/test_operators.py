from collections import Counter

import pytest

from vaultloom.operators import dedup, history, merge, quality


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_drop_all_duplicates_keeps_only_single_keys(spark):
    df = spark.createDataFrame(
        [("a", 1), ("b", 1), ("b", 2), ("c", 1), ("c", 1), ("c", 3), (None, 1), (None, 2), ("d", 5)],
        "k string, v int")
    assert rows(dedup.drop_all_duplicates(df, ["k"])) == Counter([("a", 1), ("d", 5)])


def test_drop_all_duplicates_on_several_keys_with_null(spark):
    df = spark.createDataFrame(
        [(1, None, "x"), (1, None, "y"), (1, 2.0, "z"), (None, 2.0, "w"), (0, 0.0, "p"), (0, -0.0, "q")],
        "a int, b double, v string")
    assert rows(dedup.drop_all_duplicates(df, ["a", "b"]).select("v")) == Counter([("z",), ("w",)])


def test_upsert_insert_and_batch(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    src = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert rows(merge.merge_upsert(tgt, src, ["k"])) == Counter([(1, "a"), (2, "B"), (3, "C")])
    assert rows(merge.merge_insert(tgt, src, ["k"])) == Counter([(1, "a"), (2, "b"), (3, "C")])
    assert rows(merge.new_rows(tgt, src, ["k"])) == Counter([(3, "C")])
    assert merge.merge_upsert(None, src, ["k"]) is src
    one = merge.replace_batch(None, tgt, "batch", "1")
    two = merge.replace_batch(one, src, "batch", "2")
    assert rows(merge.replace_batch(two, src, "batch", "2")) == rows(two)
    assert two.count() == 4


def test_null_safe_upsert(spark):
    tgt = spark.createDataFrame([(1, None, "a"), (1, 1, "b")], "k int, n int, v string")
    src = spark.createDataFrame([(1, None, "A")], "k int, n int, v string")
    got = merge.merge_upsert(tgt, src, ["k", "n"], null_safe=True)
    assert rows(got) == Counter([(1, 1, "b"), (1, None, "A")])


# Per load the value each key has in the source; an absent key is not in the source.
FIVE_LOADS = [
    {1: 10, 2: 20}, {1: 11, 2: 20}, {1: 12, 2: 20}, {1: 10, 3: 30}, {1: 10},
]


def day(n):
    return f"2024-01-{n:02d} 01:00:00"


def replay(close):
    """The merge row by row: the expected history as (key, value, from, to)."""
    table = []
    for n, source in enumerate(FIVE_LOADS, 1):
        changed = [(k, v) for k, v in source.items()
                   for r in table if r[0] == k and r[3] is None and r[1] != v]
        new = [(k, v) for k, v in source.items() if k not in {r[0] for r in table}]
        for r in table:
            if r[0] in source and r[1] != source[r[0]]:
                if close == history.CLOSE_ALL_DIFFERING or r[3] is None:
                    r[3] = n
        table += [[k, v, n, None] for k, v in changed + new]
    return Counter(tuple(r) for r in table)


@pytest.mark.parametrize("close", [history.CLOSE_OPEN_ONLY, history.CLOSE_ALL_DIFFERING])
def test_history_over_five_loads(spark, close):
    state = None
    for n, source in enumerate(FIVE_LOADS, 1):
        src = spark.createDataFrame(list(source.items()), "k int, v int")
        for _ in range(2):  # a repeated load changes nothing
            state = history.close_and_insert(state, src, ["k"], ["v"], day(n), close)
            state = spark.createDataFrame(state.collect(), state.schema)
    got = Counter(
        (r.k, r.v, r.valid_from.day, r.valid_to and r.valid_to.day) for r in state.collect())
    assert got == replay(close)
    if close == history.CLOSE_OPEN_ONLY:
        assert got[(1, 10, 1, 2)] and got[(1, 12, 3, 4)] and got[(2, 20, 1, None)] and got[(3, 30, 4, None)]
    else:
        assert got[(1, 11, 2, 5)] and got[(1, 12, 3, 5)]


def test_history_never_changes_on_null(spark):
    first = spark.createDataFrame([(1, None), (2, 5)], "k int, v int")
    second = spark.createDataFrame([(1, 7), (2, None)], "k int, v int")
    state = history.close_and_insert(None, first, ["k"], ["v"], day(1))
    again = history.close_and_insert(state, second, ["k"], ["v"], day(2))
    assert rows(again) == rows(state)


def test_history_rejects_unknown_mode(spark):
    src = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError):
        history.close_and_insert(None, src, ["k"], ["v"], day(1), "sometimes")


def test_quality_rules(spark):
    df = spark.createDataFrame(
        [(1, "a", "short"), (1, "b", None), (2, None, "é" * 30)], "id int, bk string, mail string")
    assert rows(quality.key_violations(df, ["id"])) == Counter([(1, 2)])
    assert rows(quality.null_violations(df, ["bk", "mail"]).select("id", "null_columns")) == Counter(
        [(1, "mail"), (2, "bk")])
    assert rows(quality.too_long(df, ["id"], {"mail": 50, "bk": 5})) == Counter([(2, "mail", 60, 50)])
    assert rows(quality.hash_collisions(df, "id", ["bk"])) == Counter([(1, 2)])
    parents = spark.createDataFrame([(1,)], "pid int")
    assert rows(quality.orphan_keys(df, "id", parents, "pid")) == Counter([(2,)])
    assert rows(quality.merge_ambiguity(df, ["bk"])) == Counter()
    assert rows(quality.merge_ambiguity(df.unionByName(df), ["bk"], null_safe=True)) == Counter(
        [("a", 2), ("b", 2), (None, 2)])
    assert quality.complete_rows(df, ["bk", "mail"]).count() == 1
