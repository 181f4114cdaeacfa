"""Language identification (operator 6).

A bidirectional gated recurrent network (GRU) reads a text's bytes and labels every
position with a probability for each language; the document's probabilities are the
means over its positions. It is trained here by backpropagation through time, in numpy.

Texts are read in segments of ``SEGMENT`` bytes, each from a zero state in both
directions, so many segments advance in one matrix product and memory is bounded
however long a text is; every byte of every text is labelled.

Training takes snippets of at most ``SAMPLED`` documents of each language (a bounded
sample of labelled rows): documents are dealt into so many slots by a hash of doc_id
and the least hash of each slot is taken, by a minimum that is combined in the tasks.
The text's snippets start at hashed places, not at its beginning.

Null text, or one without a letter: ``und`` with score 0. Rows with null lang are not
learned from. A null doc_id counts as the empty id. Without a labelled row every
prediction is ``und``. Repeated rows get equal predictions; ties go to the first
language by name. Extra columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultloom.llm.common import python_tasks, table, text_bytes

SAMPLED = 256
SNIPPETS = 4
SNIPPET_CHARS = 64
HIDDEN = 8
SEGMENT = 64
EPOCHS = 8
TRAIN_BATCH = 512
SEGMENTS_AT_ONCE = 2048
UNKNOWN = "und"


@dataclass
class Network:
    """Weights of both directions: input tables (256 x 3H), recurrent (H x 3H), output."""

    languages: list[str]
    weights: dict[str, np.ndarray]


def _new_weights(languages: int, hidden: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    w = {}
    for side in "fb":
        w[f"x{side}"] = rng.normal(0, 0.3, (256, 3 * hidden))
        w[f"u{side}"] = rng.normal(0, hidden ** -0.5, (hidden, 3 * hidden))
        w[f"o{side}"] = rng.normal(0, hidden ** -0.5, (hidden, languages))
    w["bias"] = np.zeros(languages)
    return {k: v.astype(np.float32) for k, v in w.items()}


def _squash(x: np.ndarray) -> np.ndarray:
    """Softsign, in place: smooth and bounded like tanh, at a tenth of its cost."""
    scale = np.abs(x)
    scale += 1
    x /= scale
    return x


def _slope(y: np.ndarray) -> np.ndarray:
    """Derivative of the softsign where its value is ``y``."""
    return (1 - np.abs(y)) ** 2


def _states(codes: np.ndarray, x: np.ndarray, u: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Hidden states (time x H x segments) of one direction; codes: time x segments.

    With p = x[byte] + u h for the update and reset gates, a gate is (1 + squash p) / 2;
    the reset gate's half is left to the weights. Arrays are kept feature by segment,
    so every operation runs over long contiguous rows.
    """
    size, table, mix = u.shape[0], np.ascontiguousarray(x.T), np.ascontiguousarray(u.T)
    h = np.zeros((size, codes.shape[1]), x.dtype)
    out = np.empty((codes.shape[0], *h.shape), x.dtype)
    for t in range(codes.shape[0]):
        a, g = np.take(table, codes[t], axis=1, mode="clip"), mix @ h
        gates = a[:2 * size]
        gates += g[:2 * size]
        _squash(gates)
        z, r, n, g = gates[:size], gates[size:], a[2 * size:], g[2 * size:]
        n += g
        n += r * g
        _squash(n)
        if keep is not None:
            keep.append((h, z, r, n, g))
        new = np.subtract(h, n, out=out[t])
        new *= z
        new += h
        new += n
        new *= x.dtype.type(0.5)
        h = new
    return out


def _probabilities(forward: np.ndarray, backward: np.ndarray, w: dict[str, np.ndarray]) -> np.ndarray:
    p = np.matmul(w["of"].T, forward)
    p += np.matmul(w["ob"].T, backward)
    p += w["bias"][:, None]
    p -= p.max(axis=1, keepdims=True)
    np.exp(p, out=p)
    p /= p.sum(axis=1, keepdims=True)
    return p


def position_probabilities(codes: np.ndarray, w: dict[str, np.ndarray]) -> np.ndarray:
    """Probabilities (time x languages x segments); codes: segments x time, bytes."""
    codes = np.ascontiguousarray(codes.T).astype(np.intp)
    forward = _states(codes, w["xf"], w["uf"])
    backward = _states(codes[::-1], w["xb"], w["ub"])[::-1]
    return _probabilities(forward, backward, w)


def _side_gradients(codes, w, side, kept, d_out):
    """Gradients of one direction by backpropagation through time."""
    x, u = w[f"x{side}"], w[f"u{side}"]
    dx, du, dh = np.zeros_like(x), np.zeros_like(u), np.zeros_like(kept[0][0])
    for t in range(codes.shape[0] - 1, -1, -1):
        h, z, r, n, g = kept[t]
        dh = dh + d_out[t]
        dn = dh * (1 - z) / 2 * _slope(n)
        dz = dh * (h - n) / 2 * _slope(z)
        dr = dn * g * _slope(r)
        d_in = np.concatenate((dz, dr, dn))
        d_rec = np.concatenate((dz, dr, dn * (1 + r)))
        order = np.argsort(codes[t], kind="stable")
        at = np.flatnonzero(np.diff(codes[t][order], prepend=-1))
        dx[codes[t][order][at]] += np.add.reduceat(d_in[:, order], at, axis=1).T
        du += h @ d_rec.T
        dh = dh * (1 + z) / 2 + u @ d_rec
    return dx, du


def gradients(codes: np.ndarray, labels: np.ndarray, w: dict[str, np.ndarray]) -> tuple[float, dict]:
    """Mean cross-entropy over all positions, and its gradients."""
    codes = np.ascontiguousarray(codes.T).astype(np.intp)
    kept_f, kept_b = [], []
    forward = _states(codes, w["xf"], w["uf"], kept_f)
    backward = _states(codes[::-1], w["xb"], w["ub"], kept_b)[::-1]
    p = _probabilities(forward, backward, w)
    segments = np.arange(codes.shape[1])
    loss = -float(np.log(p[:, labels, segments] + 1e-12).mean())
    d = p
    d[:, labels, segments] -= 1
    d /= codes.size
    grads = {"bias": d.sum(axis=(0, 2)), "of": np.tensordot(forward, d, ((0, 2), (0, 2))),
             "ob": np.tensordot(backward, d, ((0, 2), (0, 2)))}
    grads["xf"], grads["uf"] = _side_gradients(codes, w, "f", kept_f, np.matmul(w["of"], d))
    grads["xb"], grads["ub"] = _side_gradients(codes[::-1], w, "b", kept_b, np.matmul(w["ob"], d)[::-1])
    return loss, grads


def trained(snippets: list[tuple[str, bytes]], hidden: int = HIDDEN, epochs: int = EPOCHS) -> Network:
    """A network fitted by Adam to (language, bytes) snippets, in a fixed order."""
    languages = sorted({lang for lang, _ in snippets})
    rng = np.random.default_rng(7)
    w = _new_weights(len(languages), hidden, rng)
    if len(languages) < 2:
        return Network(languages, w)
    codes = np.zeros((len(snippets), SEGMENT), np.uint8)
    labels = np.array([languages.index(lang) for lang, _ in snippets])
    for i, (_, s) in enumerate(snippets):
        s = (s * (SEGMENT // max(1, len(s)) + 1))[:SEGMENT]  # a short one is repeated
        codes[i] = np.frombuffer(s, np.uint8)
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    step, steps = 0, max(epochs * -(-len(codes) // TRAIN_BATCH), 100)
    while step < steps:
        order = rng.permutation(len(codes))
        for at in range(0, len(order), TRAIN_BATCH):
            step += 1
            pick = order[at:at + TRAIN_BATCH]
            _, grads = gradients(codes[pick], labels[pick], w)
            rate = 0.03 * min(1, 1.5 * (1 - step / (steps + len(order) / TRAIN_BATCH + 1)))
            for k, g in grads.items():
                g = np.clip(g, -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                w[k] -= (rate * first[k] / (1 - 0.9 ** step)
                         / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return Network(languages, w)


def document_probabilities(texts: list[bytes], net: Network) -> np.ndarray:
    """Mean probabilities over all positions of each text; zeros for an empty one."""
    sizes = np.array([len(t) for t in texts], np.int64)
    sums = np.zeros((len(texts), len(net.languages)), np.float64)
    pending, owners, widths = [], [], []

    def flush():
        codes, owner = np.concatenate(pending), np.concatenate(owners)
        p = position_probabilities(codes, net.weights)
        p *= (np.arange(SEGMENT)[:, None] < np.concatenate(widths)[None, :])[:, None, :]
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        sums[owner[starts]] += np.add.reduceat(p.sum(axis=0, dtype=np.float64), starts, axis=1).T
        pending.clear(), owners.clear(), widths.clear()

    room = SEGMENTS_AT_ONCE
    for i, text in enumerate(texts):
        for at in range(0, len(text), SEGMENTS_AT_ONCE * SEGMENT):
            part = text[at:at + SEGMENTS_AT_ONCE * SEGMENT]
            n = -(-len(part) // SEGMENT)
            codes = np.zeros(n * SEGMENT, np.uint8)
            codes[:len(part)] = np.frombuffer(part, np.uint8)
            pending.append(codes.reshape(n, SEGMENT))
            owners.append(np.full(n, i))
            widths.append(np.minimum(SEGMENT, len(part) - SEGMENT * np.arange(n)))
            room -= n
            if room <= 0:
                flush()
                room = SEGMENTS_AT_ONCE
    if pending:
        flush()
    return sums / np.maximum(sizes, 1)[:, None]


def held_out():
    """Whether crc32 of doc_id as text leaves 2 when divided by 4."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(4)) == 2


def has_letter(text):
    """Whether a language can be told at all: false for null, and for text without a letter."""
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def training_snippets(docs: DataFrame, sampled: int = SAMPLED) -> list[tuple[str, bytes]]:
    """At most ``sampled`` x SNIPPETS snippets of each language, from rows that may be
    learned from. What comes to the driver is bounded by that number."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out())
    known = known.select("lang", "text", F.xxhash64("doc_id").alias("h"))
    slots = known.groupBy("lang", F.pmod("h", F.lit(sampled)).alias("slot")).agg(F.min("h").alias("h"))
    picked = [r.h for r in slots.collect()]
    pieces = [F.expr(
        f"substring(text, cast(1 + pmod(xxhash64(h, {k}), greatest(1, length(text) - {SNIPPET_CHARS}))"
        f" AS int), {SNIPPET_CHARS})") for k in range(SNIPPETS)]
    rows = (known.filter(F.col("h").isin(picked)).select("lang", "h", *[
        p.alias(f"p{k}") for k, p in enumerate(pieces)])
        .groupBy("lang", "h").agg(*[F.min(f"p{k}").alias(f"p{k}") for k in range(SNIPPETS)])).collect()
    rows.sort(key=lambda r: (r.lang, r.h))
    return [(r.lang, r[f"p{k}"].encode()) for r in rows for k in range(SNIPPETS) if r[f"p{k}"]]


def _predictions(net: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t if letters else b"" for t, letters in zip(
                b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            if not net.languages:
                texts = [b""] * len(texts)
                p = np.zeros((len(texts), 1))
            else:
                p = document_probabilities(texts, net)
            best = p.argmax(axis=1)
            lang = [net.languages[k] if t else UNKNOWN for k, t in zip(best, texts, strict=True)]
            score = np.where([bool(t) for t in texts], p[np.arange(len(p)), best], 0.0)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(lang, pa.string()),
                 pa.array(np.clip(score, 0, 1), pa.float64()), b.column(4)],
                ["doc_id", "held_out", "lang_pred", "score", "d"])

    return run


def predicted(docs: DataFrame, keep_rows: bool = False, sampled: int = SAMPLED) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, d); ``d`` holds the input row if asked for."""
    python_tasks(docs.sparkSession)
    net = trained(training_snippets(docs, sampled))
    row = F.struct(*[F.col(c) for c in docs.columns]) if keep_rows else F.lit(None).cast("int")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), text_bytes().alias("text"),
        has_letter(F.col("text")).alias("letters"), row.alias("d"))
    kind = rows.schema["d"].dataType.simpleString()
    return rows.mapInArrow(
        _predictions(net), f"doc_id long, held_out boolean, lang_pred string, score double, d {kind}")


def op6_langid(spark: SparkSession, folder: str) -> DataFrame:
    return predicted(table(spark, folder, "documents")).drop("d")
