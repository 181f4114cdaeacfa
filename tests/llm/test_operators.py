"""Each operator against brute force on small tables with nulls, ties, copies and odd texts."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from vaultloom.llm import (
    classlm, decontaminate, langid, line_dedup, packing, recompression, simhash, suffix_dedup,
    vector_dedup, warc,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, d string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = ["ab", "the", "of", "Ärger", "x", "niño", "ende", "la"]
    made = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 120))) for _ in range(25)]
    texts = [*made, *made[:6], made[0] + " " + made[1], None, None, "", "   ", "1 2 3", "x " * 3000,
             "\n".join(["a", "b", "c", "d"] * 5), "a\nb\nc", "no end\n\n\n\n\n\n"]
    found = [(i, t, None if i % 9 == 0 else "en" if i % 2 else "de", "s", 1, "r", "d") for i, t in enumerate(texts)]
    return [*found, found[3], (None, made[2], None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def bag(found):
    return Counter(tuple(r) for r in found)


def _removed(units, window):
    seen = Counter(tuple(u[i:i + window]) for u in units for i in range(len(u) - window + 1))
    for u in units:
        gone = [False] * len(u)
        for i in range(len(u) - window + 1):
            if seen[tuple(u[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        yield gone


def test_bytes(docs, rows):
    texts = [(r[1] or "").encode() for r in rows]
    want = Counter()
    for r, t, gone in zip(rows, texts, _removed(texts, 40), strict=True):
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        want[r[0], len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()] += 1
    got = suffix_dedup.deduplicated(docs, window=40, digit=12, keep=False).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert bag(got) == want


def test_words(docs, rows):
    words = [(r[1] or "").encode().split() for r in rows]
    want = Counter()
    for r, w, gone in zip(rows, words, _removed(words, 12), strict=True):
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want[r[0], len(w), sum(gone), hashlib.sha256(kept).hexdigest()] += 1
    got = recompression.deduplicated(docs, window=12, keep=False).select(
        "doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert bag(got) == want


def test_fingerprints_and_components(docs, rows, monkeypatch):
    fps = [simhash.fingerprint((r[1] or "").encode()) for r in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(fps):
            root[i] = min(root[j] for j, b in enumerate(fps) if (a ^ b).bit_count() <= 2)
    ids = [[rows[j][0] for j in range(len(rows)) if root[j] == k and rows[j][0] is not None] for k in root]
    want = Counter((r[0], f - (1 << 64) if f >> 63 else f, min(i, default=None))
                   for r, f, i in zip(rows, fps, ids, strict=True))
    for paired in (64, 1):
        monkeypatch.setattr(simhash, "PAIRED", paired)
        assert bag(simhash.near_duplicates(docs).collect()) == want


def test_lines(docs, rows):
    got = line_dedup.deduplicated(docs)
    assert got.columns == docs.columns and got.count() == len(rows)
    texts = {r.doc_id: r.text for r in got.collect() if r.doc_id is not None}
    repeated = next(r[0] for r in rows if r[1] and r[1].startswith("a\nb\nc\nd"))
    assert texts[repeated] == "a\nb\nc\nd" and texts[repeated + 1] == ""


def test_archives(spark, tmp_path):
    big = "<p>" + "ü" * 800
    pages = [(1, "http://a/ü b", big, "x"), (2, None, big, "x"), (2, "http://a", big, "x"), (3, "u", None, "x"),
             (4, "u", "", "x"), (None, "u", big, "x"), *[(i, "u", f"page {i} " * 40, "x") for i in range(5, 60)]]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, payload string")
    warc.write_archives(df, str(tmp_path / "w"), archive_bytes=2000, sample_bytes=4000, dictionary_bytes=512)
    got = warc.read_archives(spark, str(tmp_path / "w")).collect()
    want = Counter((p, u, len((h or "").encode()), None if h != big or p == 2 else 2) for p, u, h, _ in pages)
    assert Counter((r.page_id, r.url, r.payload_bytes, r.refers_to) for r in got) == want
    assert all((r.record_type == "revisit") == (r.refers_to is not None) == (r.payload is None) for r in got)
    warc.write_archives(df.limit(0), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0


def test_languages(spark, docs, rows):
    rng = random.Random(1)
    made = [(i, " ".join(rng.choice(w) for _ in range(60)), lang) for i in range(300)
            for w, lang in [(["der", "und", "keit"], "de") if i % 2 else (["the", "and", "tion"], "en")]]
    got = langid.predicted(spark.createDataFrame(made, "doc_id long, text string, lang string")).collect()
    held = [r for r in got if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.lang_pred == made[r.doc_id][2] for r in held) >= 0.95 * len(held)
    odd = {r.doc_id: r for r in langid.predicted(docs).collect()}
    assert len(odd) and all((odd[r[0]].lang_pred == "und") == (not any(map(str.isalpha, r[1] or ""))) for r in rows)
    assert all(0 <= r.score <= 1 for r in odd.values())
    assert {r.lang_pred for r in langid.predicted(docs.withColumn("lang", docs.lang.substr(9, 1)).drop("lang")
                                                  .selectExpr("*", "cast(NULL AS string) AS lang")).collect()} == {"und"}


def test_packing(docs, rows):
    got = packing.best_fit(docs, permitted=(64, 128, 256)).collect()
    words = Counter()
    for r in rows:
        words[r[0]] += len((r[1] or "").split())
    packed_words = Counter()
    for r in got:
        packed_words[r.doc_id] += r.piece_words
    assert packed_words == words
    bins = {}
    for r in got:
        if r.bin_id is not None:
            bins.setdefault((r.bin_id, r.bin_length), []).append((r.bin_offset, r.piece_words))
    for (_, size), parts in bins.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= size and not any(c < size and at <= c for c in (64, 128, 256))


def test_best_fit_is_best():
    rng = random.Random(2)
    lengths = sorted((rng.randint(1, 60) for _ in range(200)), reverse=True)
    places, sizes = packing.packed(lengths, (32, 64))
    used = Counter()
    for n, (b, at) in zip(lengths, places, strict=True):
        assert used[b] == at
        used[b] += n
    assert all(used[b] <= s for b, s in enumerate(sizes))
    assert sum(sizes) <= sum(packing.packed(lengths, (64,))[1])  # no worse than with one length


def test_vectors(spark, monkeypatch):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(12, 16))
    x = [base[i % 12] + rng.normal(size=16) * (0.03 if i < 90 else 1) for i in range(150)]
    rows = [(i, [float(v) for v in x[i]], i % 2) for i in range(150)]
    rows += [(500, rows[0][1], 0), (501, rows[0][1], 1), (502, rows[0][1], None), (503, None, 0), (504, [0.0] * 16, 0),
             (505, [float("nan")] * 16, 0), (506, [], 0), (None, rows[0][1], 0), (3, rows[3][1], 1)]
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows],
                               "vec_id long, embedding array<double>, label int, point long, root string, n_links string")
    good = [r for r in rows if r[2] is not None and r[1] and r[0] not in (504, 505)]
    unit = {id(r): np.array(r[1]) / np.linalg.norm(r[1]) for r in good}
    want = Counter((r[0], sum(s is not r and s[2] == r[2] and unit[id(r)] @ unit[id(s)] >= 0.98 for s in good)) for r in good)
    for cap in (3000, 10):
        monkeypatch.setattr(vector_dedup, "SHARD_MOST", cap)
        got = vector_dedup.linked(df)
        links = Counter((r.vec_id, r.n_links) for r in got.collect() if r.vec_id not in (502, 503, 504, 505, 506))
        assert links == want
    few = vector_dedup.audit(df, got, block=3)  # several blocks
    assert few == vector_dedup.audit(df, got) >= 0.9 and vector_dedup.linked(df.limit(0)).count() == 0


def test_vector_clusters(spark, monkeypatch, tmp_path):
    """Labels far larger than a shard: clusters of several levels, a dense group among them."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=(250, 12))
    x = np.concatenate((np.repeat(base, 4, axis=0), base[:1].repeat(300, axis=0)))
    x = x / np.linalg.norm(x, axis=1, keepdims=True) + rng.normal(size=x.shape) * 0.02
    rows = [(i, [float(v) for v in vector], "big") for i, vector in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.98
    want = {i: int(near[i].sum()) - 1 for i in range(len(x))}
    monkeypatch.setattr(vector_dedup, "FANOUT", 6)
    monkeypatch.setattr(vector_dedup, "SHARD_POINTS", 20)
    monkeypatch.setattr(vector_dedup, "SHARD_MOST", 60)
    points = vector_dedup._points(df, str(tmp_path))
    places, sizes = vector_dedup._clustered(points, str(tmp_path), 0.98)
    nodes = [r.node for r in sizes.collect()]
    assert max(nodes) > 65 and len(nodes) > 12  # children of children
    assert {len(r.leaves) for r in places.collect()} == {1, 2}
    got = {r.vec_id: r.n_links for r in vector_dedup.linked(df).collect()}
    assert all(got[i] <= want[i] for i in want)  # no link twice, none that is not there
    assert sum(got.values()) >= 0.99 * sum(want.values())


def test_vector_graph():
    """The graph grown by search leads to every link, also between far and tight groups."""
    rng = np.random.default_rng(7)
    for x in (rng.normal(size=(700, 3)), np.repeat(rng.normal(size=(100, 24)), 7, axis=0) + rng.normal(size=(700, 24)) * 0.08,
              rng.normal(size=(1, 5)), np.ones((5, 4))):
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        lists = vector_dedup.grown(x)
        assert all(i not in near and len(near) <= 2 * vector_dedup.DEGREE + vector_dedup.RANDOM_EDGES
                   for i, near in enumerate(lists))
        edges, everyone = vector_dedup._padded(lists), np.arange(len(x))
        q, v = vector_dedup.searched(x, edges, everyone, vector_dedup._medoids(x), 0.98)
        found = set(zip(q.tolist(), v.tolist()))
        true = {(i, j) for i, j in zip(*map(np.ndarray.tolist, np.nonzero(x @ x.T >= 0.98))) if i != j}
        assert len(found) == len(q) and found <= true and len(found) >= 0.99 * len(true)


def test_scores(docs, rows, monkeypatch):
    for frequent in (classlm.FREQUENT, 4):
        monkeypatch.setattr(classlm.frequent_words, "__defaults__", (frequent,))
        tokens = [(r[0], [*(r[1] or "").encode().lower().split(), b""]) for r in rows]
        held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in tokens]
        c = Counter(t for (_, w), h in zip(tokens, held, strict=True) if not h for t in w)
        n, v = sum(c.values()), len(c)
        want = Counter((d, h, len(w), sum(c[t] > 0 for t in w), n, round(sum(
            np.log10((c[t] + 1) / (n + v + 1)) for t in w), 6)) for (d, w), h in zip(tokens, held, strict=True))
        got = classlm.scored(docs).collect()
        assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                       for r in got) == want
        assert all(r.score < 0 for r in got)


def test_benchmark(spark, docs):
    item = " ".join(f"w{i % 40}" for i in range(50))
    near = item.replace("w7 ", "q ", 1)
    texts = [(1, "so " * 9 + item + " end", "s"), (2, near + " z", "s"), (3, None, "s"), (4, "w1 w2", "s"), (5, "one  Two", "s"),
             (1, "so " * 9 + item + " end", "s")]
    df = spark.createDataFrame(texts, "doc_id long, text string, h1 string")
    bench = spark.createDataFrame([(9, item), (8, "one two"), (7, None), (6, "")], "item_id long, text string")
    got = Counter((r.doc_id, r.item_id, r.start_word) for r in decontaminate.matched_documents(df, bench).collect())
    assert got == Counter({(1, 9, 9): 2, (2, 9, 0): 1, (5, 8, 0): 1})
    assert sorted(r.doc_id for r in decontaminate.clean_documents(df, bench).collect()) == [3, 4]
    assert decontaminate.clean_documents(df, bench.limit(0)).count() == 6


def test_empty_tables(docs):
    none = docs.limit(0)
    for run in (suffix_dedup.deduplicated, recompression.deduplicated, simhash.near_duplicates, line_dedup.deduplicated,
                langid.predicted, packing.best_fit, classlm.scored):
        assert run(none).count() == 0, run
