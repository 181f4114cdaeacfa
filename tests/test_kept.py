"""Drops that several steps read are prepared and written once."""

from vaultloom.plans.chain import Chain
from vaultloom.sources.scratch import written
from vaultloom.sources.tables import RAW_FEEDS


def test_staging_takes_the_kept_drops(spark, tmp_path):
    def feed(name, n):
        rows = [(f"C{i}", f"u{i}", 1000 + n, "some city", "ST") for i in range(n, n + 5)]
        return spark.createDataFrame(rows + rows[:1], RAW_FEEDS[name])

    kept = []

    def keep(df, name):
        kept.append(name)
        return written(df, str(tmp_path), name)

    c = Chain(feed, lambda n: f"2024-01-0{n} 01:00:00", "test", keep=keep)
    c.prepare_together(["customers"], 2)
    drops = [f"prepared.customers-{n}" for n in (1, 2)]
    assert [name for name in sorted(kept) if name.startswith("prepared")] == drops
    staged = c.staged_kept("customers", 2)
    assert len(kept) == len(set(kept))  # none is written twice, over what others read
    assert sorted((r.customer_id, r.zip_code) for r in staged.collect()) == [
        ("C2", 1001), *[(f"C{i}", 1002) for i in range(3, 7)]]
    assert any(drops[0] in f for f in c.prepared_kept("customers", 1).inputFiles())
