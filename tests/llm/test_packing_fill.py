"""Bins are filled as well as by one best-fit run over all pieces."""

import random

from vaultloom.llm import packing


def test_a_shard_holds_many_pieces(spark):
    rng = random.Random(8)
    lengths = [rng.randint(1, 60) for _ in range(4000)]
    docs = spark.createDataFrame([(i, "w " * n) for i, n in enumerate(lengths)], "doc_id long, text string")
    got = packing.best_fit(docs, permitted=(32, 64)).dropDuplicates(["bin_id"]).collect()
    assert sum(r.bin_length for r in got) == sum(packing.packed(sorted(lengths, reverse=True), (32, 64))[1])


def brute_packed(lengths, permitted, overhead):
    """Best fit by plain scans: the fullest open bin, else the length that is cheapest a word."""
    bins, places = [], []  # [length, filled]
    for at, size in enumerate(lengths):
        fits = [(b[0] - b[1] - size, n) for n, b in enumerate(bins) if b[0] - b[1] >= size]
        if fits:
            n = min(fits)[1]
        else:
            costs = []
            for c in permitted:
                if c < size:
                    continue
                room = c - size
                for other in lengths[at + 1:]:  # falling: the largest that still fits, each once
                    room -= other if other <= room else 0
                costs.append(((c + overhead) / (c - room), -c))
            n = len(bins)
            bins.append([-min(costs)[1], 0])
        places.append((n, bins[n][1]))
        bins[n][1] += size
    return places, [min(c for c in permitted if c >= filled) for _, filled in bins]


def test_packing_equals_brute_force():
    rng = random.Random(9)
    for n in (0, 1, 2, 7, 60, 150):
        for permitted, overhead in (((32, 64), 16), ((16, 40, 100), 3), ((100,), 0), ((10, 20, 40, 80), 50)):
            lengths = sorted((rng.randint(1, max(permitted)) for _ in range(n)), reverse=True)
            assert packing.packed(lengths, permitted, overhead) == brute_packed(lengths, permitted, overhead)
