"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from vaultloom.llm import spelling

DOCS = "doc_id long, text string, word string, n long, a string"


def brute(rows, least_length, least_count, ratio, delete_every):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % delete_every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    forms = {}
    for w, n in words.items():
        close = sorted((v for v in words if near(w, v)), key=lambda v: (-words[v], v))
        form = close[0] if close and words[close[0]] >= ratio * n else None
        forms[w] = (form, len(close))
    found = set()
    for w, (form, n_near) in forms.items():
        root = w
        while forms[root][0]:
            root = forms[root][0]
        found.add((w, form, root, words[w], n_near, words[form] if form else None))
    return found


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    stems = ["".join(rng.choice("abé") for _ in range(rng.randint(4, 9))) for _ in range(12)]
    stems += ["aaaaaaaa", "aaaaaaa", "×÷×÷×÷ÿ", "ÄÖÜÄÖÜÄ", "straße", "x"]
    texts = []
    for i in range(150):
        words = []
        for _ in range(rng.randint(0, 60)):
            w = stems[min(rng.randrange(len(stems)), rng.randrange(len(stems)))]
            if rng.random() < 0.08:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1:], w[:at] + "é" + w[at:], w[:at] + "b" + w[at + 1:]])
            words.append(w.upper() if i % 7 == 0 and w.isascii() else w)
        texts.append(rng.choice([" ", "-", "1", "\n"]).join(words))
    texts += ["", None, "123 …", "a" * 5000 + " " + "a" * 5000, ("wordone wordtwo " * 20_000)]
    found = [(i, t, "w", 1, "a") for i, t in enumerate(texts)]
    return [*found, found[4], found[4], (None, texts[5], None, None, None), (None, None, None, None, None)]


@pytest.mark.parametrize(("how", "pass_words"), [((4, 2, 10, 31), 1 << 23), ((4, 1, 2, 5), 1 << 23), ((4, 1, 2, 5), 20)])
def test_words_forms_and_roots(spark, rows, monkeypatch, how, pass_words):
    monkeypatch.setattr(spelling, "PASS_WORDS", pass_words)
    got = spelling.variants(spark.createDataFrame(rows, DOCS), *how)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute(rows, *how)
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(want) and set(found) == want
    assert any(form and root != form for _, form, root, *_ in want) or how[2] == 10


def test_no_words(spark, rows):
    docs = spark.createDataFrame(rows, DOCS)
    assert spelling.variants(docs.limit(0)).count() == 0
    assert spelling.variants(docs.filter("text = ''")).count() == 0


def test_filters_hold_every_word_and_few_others(spark):
    words = [f"word{i:05d}" for i in range(20_000)]
    table = spark.createDataFrame([(w,) for w in words], "word string")
    blooms = spelling.filters(table, {9: len(words)}, 1, 0)
    assert spelling._held(spelling.word_hashes(words, 9), blooms[9], 1, 0).all()
    others = [f"none{i:05d}" for i in range(20_000)]
    assert spelling._held(spelling.word_hashes(others, 9), blooms[9], 1, 0).mean() < 0.005


def test_edits_of_a_word():
    """Against filters that hold everything, all edits to the word's length or one less come, once."""
    full = {n: np.full(1, np.uint64(0xFFFFFFFFFFFFFFFF)) for n in (3, 4)}
    places, edits = spelling.held_edits(["abba"], 4, np.array([ord("a"), ord("b"), ord("c")], np.uint64), full)
    assert set(places) == {0}
    assert Counter(edits) == Counter(["bba", "aba", "abb", "bbba", "cbba", "acba", "abca", "abbb", "abbc"])
