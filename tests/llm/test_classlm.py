"""The class language model against brute force."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from vaultloom.llm import classlm

DOCS = "doc_id long, text string, word string, n long, cls string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(21)
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(words[min(rng.randrange(30), rng.randrange(30))] for _ in range(rng.randint(0, 40))) for _ in range(60)]
    texts += [None, "", "only here", "Only HERE", "far w0 far far", "w1 " * 500]
    found = [(i, t, "w", 1, "c") for i, t in enumerate(texts)]
    return [*found, found[2], (None, texts[3], None, None, None)]


def brute(rows, seed_size):
    """Scores by the docstring, word by word; classes of the seed from the exchange itself."""
    texts = [((r[1] or "").encode().lower().split() + [b""]) for r in rows]
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 2 for r in rows]
    train = [t for t, h in zip(texts, held, strict=True) if not h]
    counts = Counter(w for t in train for w in t)
    seed = sorted(counts, key=lambda w: (-counts[w], w))[:seed_size]
    seed = seed if b"" in seed else [*seed[:-1], b""]
    pairs = Counter(p for t in train for p in zip([b"", *t], t))
    m = np.array([[pairs[a, b] for b in seed] for a in seed])
    cls = dict(zip(seed, classlm.exchange_clusters(m).tolist(), strict=True))
    k = classlm.CLASSES
    b = np.full((k, k), classlm.DELTA)
    for x in seed:
        for y in seed:
            b[cls[x], cls[y]] += pairs[x, y]
    follows, share = b / b.sum(1, keepdims=True), b.sum(0) / b.sum()
    for w in set(counts) - set(seed):
        best = np.log(share)
        for (x, y), n in pairs.items():
            if y == w and x in seed:
                best = best + n * np.log(follows[cls[x]] / share)
            if x == w and y in seed:
                best = best + n * np.log(follows[:, cls[y]])
        cls[w] = int(best.argmax())
    steps = np.full((k, k), classlm.DELTA)
    for (x, y), n in pairs.items():
        steps[cls[x], cls[y]] += n
    steps = np.log10(steps / steps.sum(1, keepdims=True))
    shares = np.zeros(k)
    for w, n in counts.items():
        shares[cls[w]] += n + 1
    shares = np.log10(shares + 1)
    for t in texts:
        total, before = 0.0, cls[b""]
        for w in t:
            now = cls[w] if w in counts else int(np.argmax(steps[before] - shares))
            total += steps[before, now] + math.log10(counts[w] + 1) - shares[now]
            before = now
        yield total


@pytest.mark.parametrize(("seed", "frequent"), [(8, 1 << 17), (8, 3), (100, 10)])
def test_scores_equal_brute_force(spark, rows, monkeypatch, seed, frequent):
    monkeypatch.setattr(classlm, "SEED", seed)
    monkeypatch.setattr(classlm.frequent_words, "__defaults__", (frequent,))
    got = classlm.scored(spark.createDataFrame(rows, DOCS)).collect()
    want = Counter((r[0], round(s, 6)) for r, s in zip(rows, brute(rows, seed), strict=True))
    assert Counter((r.doc_id, round(r.score, 6)) for r in got) == want


def test_exchange_ends_where_no_move_gains():
    rng = np.random.default_rng(5)
    m = rng.integers(0, 30, (14, 14))
    cls = classlm.exchange_clusters(m, classes=3, sweeps=50)

    def likelihood(cls):
        b = np.array([[m[cls == i][:, cls == j].sum() for j in range(3)] for i in range(3)], float)
        return sum((x * np.log(np.maximum(x, 1))).sum() for x in (b,)) - sum(
            (x * np.log(np.maximum(x, 1))).sum() for x in (b.sum(0), b.sum(1)))

    now = likelihood(cls)
    for u in range(14):
        for k in range(3):
            moved = cls.copy()
            moved[u] = k
            assert likelihood(moved) <= now + 1e-6


def test_a_flat_vocabulary_has_no_cliff(spark, monkeypatch):
    """300 words, all as frequent: how many are looked up in the tasks changes no score."""
    rng = random.Random(3)
    docs = []
    for i in range(20):
        words = [f"v{j}" for j in range(300)]
        rng.shuffle(words)
        docs.append((i, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = []
    for most in (200, 302, 1 << 17):
        monkeypatch.setattr(classlm.frequent_words, "__defaults__", (most,))
        found.append({r.doc_id: round(r.score, 9) for r in classlm.scored(df).collect()})
    assert found[0] == found[1] == found[2]


def test_no_training_rows(spark):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    got = classlm.scored(spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")).collect()
    assert all(r.held_out and r.n_known == 0 and r.train_tokens == 0 and r.n_tokens == 3 and r.score < 0 for r in got)


def test_words_outside_the_seed_class_by_all_their_bigrams(spark, monkeypatch):
    """Words of a seed of three and the rest: each bigram counts, at both its ends."""
    monkeypatch.setattr(classlm, "SEED", 3)
    docs = list(enumerate(f"a {x} z{i} b" for i in range(12) for x in "xq"))
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    words = classlm.seed_words(classlm.word_counts(df), 3)
    assert sorted(words) == [b"", b"a", b"b"]
    train = [t.encode().split() + [b""] for (_, t), h in zip(docs, held, strict=True) if not h]
    number = {w: i for i, w in enumerate(words)}
    want = np.zeros((4, 4), int)
    cells = Counter()
    for t in train:
        for x, y in zip([b"", *t], t):
            i, j = number.get(x, 3), number.get(y, 3)
            want[i, j] += 1
            if j == 3:
                cells[y, i if i < 3 else classlm.CLASSES] += 1
            if i == 3:
                cells[x, classlm.CLASSES + 1 + (j if j < 3 else classlm.CLASSES)] += 1
    m = classlm.seed_matrix(df, words, others=True)
    assert (m == want).all() and m.sum() == sum(map(len, train))  # no bigram is left out
    learned = df.filter(~classlm.held_out()).selectExpr("cast(text AS binary) AS text")
    found = learned.mapInArrow(classlm._word_bigrams(number, True), "word binary, cell int, n long").collect()
    got = Counter()
    for r in found:
        got[bytes(r.word), r.cell] += r.n
    assert got == cells
    cls = classlm.exchange_clusters(m, others=True)
    assert cls[3] == classlm.CLASSES and (cls[:3] < classlm.CLASSES).all()
    weights, prior = classlm.class_weights(m, cls, others=True)
    own = {bytes(r.word): r.cls for r in classlm.classed_words(df, classlm.word_counts(df), True).collect()}
    row = [*cls[:3], classlm.CLASSES]  # of the weights, before a word
    rows = [*row, *[classlm.CLASSES + 1 + k for k in row]]
    numbered = {c: i for i, c in enumerate([0, 1, 2, classlm.CLASSES])}
    numbered.update({classlm.CLASSES + 1 + c: 4 + i for c, i in list(numbered.items())})
    for w in {w for w, _ in cells}:
        by = prior + sum(n * weights[rows[numbered[c]]] for (v, c), n in cells.items() if v == w)
        assert own[w] == by.argmax()


ODD = [b"  A b\x0bc ", b"", b" \n\t", b"x\x1cy \xff\xfeZ\xc3\x89\t\r\x0c q", b"\x00 \x85 \xc2\xa0 \x1f", "\u00c0\u00c9 B".encode(), b"a"]


def test_tokens_split_at_six_bytes_only():
    want = [[*t.lower().split(), b""] for t in ODD]
    for texts in (pa.array(ODD, pa.binary()), pa.array([b"no", *ODD], pa.binary())[1:], pa.array(ODD, pa.large_binary())):
        found, lengths = classlm.tokens(texts)
        assert found.to_pylist() == sum(want, []) and lengths.tolist() == [len(t) for t in want]


def batches(texts, *columns):
    return [pa.RecordBatch.from_arrays([pa.array([t], pa.binary()), *(pa.array([c[i]]) for c in columns)], ["text", *"abc"[:len(columns)]])
            for i, t in enumerate(texts)]


@pytest.mark.parametrize("at_once", [1, 7, 1 << 22])
def test_vocabularies_add_up(monkeypatch, at_once):
    monkeypatch.setattr(classlm, "NUMBERED_AT_ONCE", at_once)
    texts = [*ODD, b"a b a", b"b"]
    held = [i % 3 == 1 for i in range(len(texts))]
    n, seen = Counter(), Counter()
    for b in classlm._counted(iter(batches(texts, held))):
        for r in b.to_pylist():
            n[r["word"]] += r["n"]
            seen[r["word"]] += r["seen"]
    split = [[*t.lower().split(), b""] for t in texts]
    assert seen == Counter(w for t in split for w in t)
    assert +n == Counter(w for t, h in zip(split, held, strict=True) if not h for w in t)


@pytest.mark.parametrize("others", [False, True])
def test_a_word_is_one_row_of_a_vocabulary(monkeypatch, others):
    """Rows that are exchanged: one for each word, with all its cells, not one for each cell."""
    seed = {b"a": 3, b"b": 1, b"": 0}
    texts = [b"a x b y", b"x x a", b"b x y z", b"a b"]
    rows = [r for b in classlm._packed(classlm._word_bigrams(seed, others))(iter(batches(texts))) for r in b.to_pylist()]
    assert sorted(r["word"] for r in rows) == [b"x", b"y", b"z"]
    side, want = classlm.CLASSES + others, Counter()
    for t in texts:
        t = [*t.split(), b""]
        for x, y in zip([b"", *t], t):
            if y not in seed and (others or x in seed):
                want[y, seed.get(x, classlm.CLASSES)] += 1
            if x not in seed and (others or y in seed):
                want[x, side + seed.get(y, classlm.CLASSES)] += 1
    got = Counter({(r["word"], int(c) & 255): int(c) >> 8 for r in rows for c in np.frombuffer(r["cells"], "<i8")})
    assert got == want
    # rows of a word from several tasks, in batches that part them, give the class of their sum
    weights, prior = np.random.default_rng(2).normal(size=(2 * side, classlm.CLASSES)), np.linspace(0, 1, classlm.CLASSES)
    monkeypatch.setattr(classlm._gathered, "__defaults__", (2,))
    parted = sorted((r["word"], np.int64(c).tobytes()) for r in rows for c in np.frombuffer(r["cells"], "<i8"))
    parted = [pa.RecordBatch.from_arrays([pa.array([w]), pa.array([c])], ["word", "cells"]) for w, c in parted]
    found = {r["word"]: r["cls"] for b in classlm._likeliest(weights, prior)(iter(parted)) for r in b.to_pylist()}
    assert found == {w: int((prior + sum(n * weights[c] for (v, c), n in want.items() if v == w)).argmax()) for w in (b"x", b"y", b"z")}


def test_no_rows(spark):
    assert classlm.scored(spark.createDataFrame([], "doc_id long, text string"), others=True).collect() == []
