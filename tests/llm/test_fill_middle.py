"""Fill-in-the-middle against a brute force over strings, and the way back."""

import hashlib
import random
import re
from collections import Counter

import pytest

from vaultloom.llm import fill_middle

DOCS = "doc_id long, text string, n long, form string, output string"


def brute(doc_id, text, rate=100, spm=50, seed=7, sentinels=("<P>", "<S>", "<M>")):
    text = text or ""
    units = re.findall("[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(s in text for s in sentinels) or h3 % 100 >= rate:
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    p, s, m = sentinels
    if h4 % 100 < spm:
        return len(units), "spm", len(prefix), len(middle), s + suffix + p + prefix + m + middle
    return len(units), "psm", len(prefix), len(middle), p + prefix + s + suffix + m + middle


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    made = ["".join(rng.choice(["a", "é", "\n", "\n\n", "<", "<P", "M>", "\r", "x" * 30, "𝄞", " "]) for _ in range(rng.randint(0, 40)))
            for _ in range(120)]
    texts = [*made, None, None, "", "\n", "one line", "a<P>b\nc", "<M>", "<S\n>", "x\n" * 300_000, made[0], made[0]]
    return [(i, t, 9, "f", "o") for i, t in enumerate(texts)] + [
        (3, made[3], 1, None, None), (3, made[3], 1, None, None), (None, made[5], None, None, None), (None, None, None, None, None)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("how", [{}, {"rate": 40, "spm": 10, "seed": 3, "sentinels": (b"<fim>", b"<end>", b"<mid>")}])
def test_outputs_and_the_way_back(spark, rows, how):
    docs = spark.createDataFrame(rows, DOCS)
    names = {**how, "sentinels": tuple(s.decode() for s in how["sentinels"])} if how else {}
    found = fill_middle.rearranged(docs, **how).cache()
    want = [(r[0], *brute(r[0], r[1], **names), r[1] or "") for r in rows]
    assert Counter(tuple(r) for r in found.collect()) == Counter((*w[:-1], sha(w[-2]), sha(w[-1])) for w in want)
    assert {"psm", "spm", "plain"} == {w[2] for w in want}
    back = fill_middle.restored_texts(found, how.get("sentinels", fill_middle.SENTINELS)).collect()
    assert Counter(tuple(r) for r in back) == Counter((r[0], r[1] or "") for r in rows)
    found.unpersist()
    hashed = fill_middle.rearranged(docs, texts=False, **how).drop("output").collect()
    assert Counter(tuple(r) for r in hashed) == Counter((*w[:-2], sha(w[-2]), sha(w[-1])) for w in want)


def test_no_rows(spark, rows):
    none = spark.createDataFrame(rows[:1], DOCS).limit(0)
    assert fill_middle.rearranged(none).count() == 0
    assert fill_middle.restored_texts(fill_middle.rearranged(none)).count() == 0


def test_pieces_point_at_the_text():
    """Neither cutting nor arranging copies text."""
    text = b"one\ntwo\nthree"
    pieces = fill_middle.arranged(fill_middle.cut(text, 4, 8, fill_middle.SENTINELS), "spm")
    assert fill_middle.joined(pieces) == b"<S>three<P>one\n<M>two\n"
    assert all(p.buffer.obj is text for p in pieces[1::2])
    assert fill_middle.streamed_sha256(pieces) == hashlib.sha256(b"<S>three<P>one\n<M>two\n").hexdigest()
