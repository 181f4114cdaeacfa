"""Class-based n-gram scores of texts (operator 9).

Words are in classes, after Brown: the probability of a word is that of its class after
the class before, times that of the word among its class's words. Tokens are the
lower-cased (A-Z) words of a text and then one end, which is the empty word here.

Arrow splits texts and looks words up, a task's tokens some million at a time. All counts
cover all training texts, and every training word has a class of its own:

1. Words are counted (in tasks first, then by word). The table of counts grows with the
   corpus and stays in Spark.
2. The ``SEED`` most frequent words (ties in word order) are put in ``CLASSES`` classes by
   exchange clustering: words move between classes as long as the likelihood of the seed's
   class bigrams grows.
3. Every other word's bigrams with seed words are counted by class and side over the
   corpus. A word goes to the class under which its own bigrams are likeliest, given the
   seed's class bigrams; one without a seed word beside it, to the most frequent class.
   With ``others``, as operator 9 asks, all words outside the seed are one unit more, in a
   class of its own that no word joins: bigrams with them count in 2 and 3 like any other,
   so that no bigram is left out and each word goes by its whole context.
4. Texts become sequences of classes, a byte a token. The ``FREQUENT`` most frequent words
   are looked up in the tasks, all others by a join with the table of words; which words
   are looked up where changes the work but no score.
5. Class bigrams of all training tokens are counted from the sequences, and texts scored.

The score is the log10 probability: transitions are smoothed by adding ``DELTA``, words
by adding one, with one share in each class for all its unknown words. An unknown word
takes the class that is likeliest after the class before. ``perplexity`` is
10 ** (-score / n_tokens). The base score is the add-one unigram model's.

Null text counts as empty: its one token is the end. A null doc_id counts as the empty
id. With no training rows all counts are zero and all words unknown. Repeated rows are
scored, and learned from, each. Extra columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultloom.llm.common import python_tasks, table, text_bytes
from vaultloom.sources.scratch import scratch_folder, written

FREQUENT = 1 << 17
"""Words that the tasks look up by themselves, at most."""
SEED = 512
CLASSES = 32
SWEEPS = 10
DELTA = 0.5
NUMBERED_AT_ONCE = 1 << 22
"""Tokens of which a task makes a vocabulary of its own; one batch more at most."""
LOOKED_UP_AT_ONCE = 1 << 20
NO_CLASS = 255
END = b""


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The tokens of texts, one text after the other, and how many each has."""
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(texts.cast(pa.binary()).view(pa.string())))
    # a blank behind a text makes its end the empty word; an empty text is one by itself
    ended = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(texts, "", " "))
    lists = pc.ascii_split_whitespace(ended)
    return lists.flatten().view(pa.binary()), lists.value_lengths().to_numpy()


def _numbers(words: pa.ChunkedArray | pa.Array, known: pa.Array) -> np.ndarray:
    """The place of each word in ``known``, or its length for all others."""
    return pc.fill_null(pc.index_in(words, value_set=known), len(known)).to_numpy()


def _vocabularies(batches: Iterator[pa.RecordBatch]):
    """(words, numbers, lengths, columns behind the text): some batches' distinct words, the
    places in them of their tokens, and how many tokens each text has."""
    pending, held = [], 0

    def numbered():
        found, lengths, columns = zip(*pending, strict=True)
        pending.clear()
        coded = pa.chunked_array(found, pa.binary()).dictionary_encode().combine_chunks()
        columns = [pa.chunked_array(c) for c in zip(*columns, strict=True)]
        return coded.dictionary, coded.indices.to_numpy(), np.concatenate(lengths), columns

    for b in batches:
        found, lengths = tokens(b.column(0))
        pending.append((found, lengths, b.columns[1:]))
        held += len(found)
        if held > NUMBERED_AT_ONCE:
            yield numbered()
            held = 0
    if held:
        yield numbered()


def held_out():
    """Whether crc32 of doc_id as text leaves 2 when divided by 7."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(7)) == 2


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        held_out().alias("held_out"), text_bytes().alias("text"))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n, seen): occurrences in training texts, and in all."""
    for words, numbers, lengths, (held,) in _vocabularies(batches):
        learned = np.repeat(~held.to_numpy(), lengths)
        n = np.bincount(numbers[learned], minlength=len(words))
        seen = np.bincount(numbers, minlength=len(words))
        for at in range(0, len(words), 50_000):
            yield pa.RecordBatch.from_arrays(
                [words[at:at + 50_000], pa.array(n[at:at + 50_000]), pa.array(seen[at:at + 50_000])], ["word", "n", "seen"])


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n, seen) of all distinct words of the corpus, stored."""
    python_tasks(docs.sparkSession)
    parts = _numbered(docs).select("text", "held_out").mapInArrow(_counted, "word binary, n long, seen long")
    return written(parts.groupBy("word").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen")),
                   scratch_folder(docs.sparkSession), "counts")


def seed_words(counts: DataFrame, most: int) -> list[bytes]:
    """The most frequent training words, ties in word order; the end is one of them."""
    top = counts.filter("n > 0").orderBy(F.desc("n"), "word").limit(most).select("word").collect()
    words = [bytes(r.word) for r in top]
    return words if END in words or not words else [*words[:most - 1], END]


def _seed_bigrams(seed: dict[bytes, int], others: bool = False):
    """(cell, n) of the seed's words, which are numbered from 0 in their order."""
    known = len(seed)
    size = known + others

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, words = np.zeros(size * size, np.int64), pa.array(list(seed), pa.binary())
        for b in batches:
            # behind a first end each text starts after one, as if after its own: neighbours are all bigrams
            ids = np.concatenate(([seed[END]], _numbers(tokens(b.column(0))[0], words)))
            before, behind = ids[:-1], ids[1:]
            if not others:
                both = (before < known) & (behind < known)
                before, behind = before[both], behind[both]
            found += np.bincount(before * size + behind, minlength=len(found))
        cells = np.flatnonzero(found)
        for at in range(0, len(cells), 50_000):
            part = cells[at:at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(found[part])], ["cell", "n"])

    return run


def _matrix(cells: DataFrame, size: int) -> np.ndarray:
    """Counts of (cell, n), at most size x size rows, as a matrix."""
    got = cells.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    m = np.zeros(size * size, np.int64)
    m[got["cell"].to_numpy(dtype=np.int64)] = got["n"].to_numpy()
    return m.reshape(size, size)


def seed_matrix(docs: DataFrame, words: list[bytes], others: bool = False) -> np.ndarray:
    """Bigrams of the seed's words over all training texts; with ``others`` the last unit
    is all other words."""
    learned = _numbered(docs).filter(~F.col("held_out")).select("text")
    found = learned.mapInArrow(_seed_bigrams({w: i for i, w in enumerate(words)}, others), "cell int, n long")
    return _matrix(found, len(words) + others)


def _word_bigrams(seed: dict[bytes, int], others: bool = False):
    """(word, cell, n) of words outside the seed; the cell is the class of a seed word
    before them, or ``CLASSES`` and that of one behind them. With ``others`` each side has a
    cell more, for words outside the seed."""
    side = CLASSES + others

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, classes = pa.array(list(seed), pa.binary()), np.array([*seed.values(), CLASSES], np.int32)
        for words, numbers, *_ in _vocabularies(batches):
            cell = classes[_numbers(words, known)]
            # behind a first end each text starts after one, as if after its own
            cells = np.empty(len(numbers) + 1, np.int32)
            cells[0], cells[1:] = seed[END], cell[numbers]
            other = cells == CLASSES
            into, out = other[1:], other[1:-1]
            if not others:
                into, out = into & ~other[:-1], out & ~other[2:]
            keys = np.concatenate((numbers[into].astype(np.int64) * (2 * side) + cells[:-1][into],
                                   numbers[:-1][out].astype(np.int64) * (2 * side) + side + cells[2:][out]))
            keys.sort()
            new = np.ones(len(keys), bool)
            new[1:] = keys[1:] != keys[:-1]
            first = np.flatnonzero(new)
            n, keys = np.diff(first, append=len(keys)), keys[first]
            for at in range(0, len(keys), 100_000):
                part = keys[at:at + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [words.take(pa.array(part // (2 * side))), pa.array((part % (2 * side)).astype(np.int32)),
                     pa.array(n[at:at + 100_000])], ["word", "cell", "n"])

    return run


def _runs(words: pa.Array) -> np.ndarray:
    """Where a run of equal words begins."""
    return np.flatnonzero(np.concatenate(([True], pc.not_equal(words[1:], words[:-1]).to_numpy(zero_copy_only=False))))


def _packed(bigrams):
    """(word, cells): a row for neighbouring (word, cell, n) of one word; cells are 8 bytes
    each, the number in the lowest and the count above it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bigrams(batches):
            first = _runs(b.column(0))
            cells = b.column(2).to_numpy() << 8 | b.column(1).to_numpy()
            ends = np.append(first, len(cells)).astype(np.int32) * 8
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(first)),
                 pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(cells.astype("<i8"))])],
                ["word", "cells"])

    return run


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 50_000) -> Iterator[tuple[pa.Array, pa.Array]]:
    """The two columns of batches sorted by the first, many batches at a time, whose parts
    hold all rows of their words."""
    pending, held = [], 0
    for b in batches:
        pending.append(b)
        held += b.num_rows
        if held >= rows:
            words, cells = (c.combine_chunks() for c in pa.Table.from_batches(pending).columns)
            last = int(_runs(words)[-1])
            if last:
                yield words[:last], cells[:last]
            pending = [pa.RecordBatch.from_arrays([words[last:], cells[last:]], names=b.schema.names)]
            held = len(words) - last if last else 0  # one word's rows: as many more
    if sum(b.num_rows for b in pending):
        words, cells = (c.combine_chunks() for c in pa.Table.from_batches(pending).columns)
        yield words, cells


def _likeliest(weights: np.ndarray, prior: np.ndarray):
    size = len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, packed in _gathered(batches):
            first = _runs(words)
            cells, ends = _flat(packed, "<i8")
            word = np.repeat(np.repeat(np.arange(len(first)), np.diff(first, append=len(words))), np.diff(ends))
            found = np.bincount(word * size + (cells & 255), cells >> 8, minlength=len(first) * size)  # whole numbers
            at = np.flatnonzero(found)
            begins = np.searchsorted(at, np.arange(len(first)) * size)
            scores = np.add.reduceat(weights[at % size] * found[at, None], begins, axis=0) + prior
            yield pa.RecordBatch.from_arrays(
                [words.take(pa.array(first)), pa.array(scores.argmax(axis=1).astype(np.int32))], ["word", "cls"])

    return run


def _flat(values: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """What binary values hold, one behind the other, as an array of ``kind``, and where each
    begins and the last ends in it. There is a value at least."""
    values = values.cast(pa.binary())
    ends = np.frombuffer(values.buffers()[1], np.int32)[values.offset:values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(kind)
    return data, (ends - ends[0]) // data.itemsize


def class_weights(m: np.ndarray, cls: np.ndarray, others: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """What a bigram of each cell speaks for each class, and the classes' log shares.

    After a seed word of class j a word of class k has P(k | j) / P(k) times its share of
    all words; before one, P(j | k) counts. The class of ``others`` is a j but no k.
    """
    member = np.zeros((len(m), CLASSES + others))
    member[np.arange(len(m)), cls] = 1
    b = member.T @ m @ member + DELTA
    into = b[:, :CLASSES]
    share = np.log(into.sum(0) / into.sum())
    before = np.log(into / into.sum(1, keepdims=True)) - share  # [j, k]
    behind = np.log(b / b.sum(1, keepdims=True))[:CLASSES].T  # [j, k]: from k to j
    return np.concatenate((before, behind)), share


def classed_words(docs: DataFrame, counts: DataFrame, others: bool = False) -> DataFrame:
    """(word, n, seen, cls): every word of the corpus; unknown ones have no class. Stored."""
    spark, folder = docs.sparkSession, scratch_folder(docs.sparkSession)
    words = seed_words(counts, SEED)
    if not words:
        return written(counts.withColumn("cls", F.lit(None).cast("int")), folder, "words")
    m = seed_matrix(docs, words, others)
    cls = exchange_clusters(m, others=others)
    weights, prior = class_weights(m, cls, others)
    seed = {w: int(k) for w, k in zip(words, cls[:len(words)], strict=True)}
    parts = (_numbered(docs).filter(~F.col("held_out")).select("text")
             .mapInArrow(_packed(_word_bigrams(seed, others)), "word binary, cells binary"))
    # a word's rows, one from each vocabulary with it, meet in one task, one behind the other
    sorted_parts = parts.repartition("word").sortWithinPartitions("word")
    assigned = sorted_parts.mapInArrow(_likeliest(weights, prior), "word binary, cls int").unionByName(
        spark.createDataFrame(list(seed.items()), "word binary, cls int"))
    assigned = written(assigned, folder, "assigned")
    found = counts.join(assigned, "word", "left").withColumn(
        "cls", F.when(F.col("n") > 0, F.coalesce("cls", F.lit(int(prior.argmax())))))
    return written(found, folder, "words")


def _xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)


def exchange_clusters(
    m: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS, others: bool = False
) -> np.ndarray:
    """The class of each unit: units move, one at a time in order of frequency, to the class
    with the largest likelihood of the class bigrams, until a sweep moves none. With
    ``others`` the last unit stays alone, in a class after these."""
    m = m.astype(np.float64)
    size = len(m) - others
    order = np.argsort(-(m.sum(0) + m.sum(1))[:size], kind="stable")
    cls = np.full(len(m), classes)
    cls[order] = np.arange(size) % classes
    member = np.zeros((len(m), classes + others))
    member[np.arange(len(m)), cls] = 1
    after, before = m @ member, m.T @ member  # unit x class: followers, predecessors
    b = member.T @ after
    for _ in range(sweeps):
        moved = 0
        for u in order:
            old, own = cls[u], m[u, u]
            out, into = after[u].copy(), before[u].copy()
            out[old] -= own
            into[old] -= own
            if not out.any() and not into.any() and not own:
                continue
            b[old] -= out
            b[:, old] -= into
            b[old, old] -= own
            rows, cols = b.sum(1) + into, b.sum(0) + out  # wherever the unit goes
            # likelihood gained by joining class k: its row, column, diagonal, and both margins
            gain = (_xlogx(b + out).sum(1) - _xlogx(b).sum(1)
                    + _xlogx(b + into[:, None]).sum(0) - _xlogx(b).sum(0))
            d = np.diagonal(b)
            gain += (_xlogx(d + out + into + own) - _xlogx(d + out) - _xlogx(d + into) + _xlogx(d))
            gain -= _xlogx(rows + out.sum() + own) - _xlogx(rows)
            gain -= _xlogx(cols + into.sum() + own) - _xlogx(cols)
            new = int(np.argmax(gain[:classes]))
            if gain[new] <= gain[old] + 1e-9:
                new = old
            b[new] += out
            b[:, new] += into
            b[new, new] += own
            if new != old:
                cls[u] = new
                after[:, old] -= m[:, u]
                after[:, new] += m[:, u]
                before[:, old] -= m[u]
                before[:, new] += m[u]
                moved += 1
        if not moved:
            break
    return cls


SEQUENCED = ("row long, doc_id long, held_out boolean, cls binary, n_known long, logs double, "
             "rest array<struct<word: binary, place: int>>")


def _bytes(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values that lie in a row in ``data``."""
    return pa.Array.from_buffers(
        pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def _sequenced(shared):
    """Classes, known tokens and the sum of log10(n + 1) of frequent words; the others' places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, classes, logs = shared.value
        classes, logs = np.append(classes, np.uint8(NO_CLASS)), np.append(logs, 0.0)
        pending, held = [], 0

        def looked_up():
            ids = _numbers(pa.chunked_array([found for _, found, _ in pending], pa.binary()), frequent)
            at = 0
            for b, found, lengths in pending:
                part = ids[at:at + len(found)]
                at += len(found)
                ends = np.concatenate(([0], np.cumsum(lengths)))
                cls = classes[part]
                rest = np.flatnonzero(part == len(frequent))
                rests = np.searchsorted(rest, ends)
                places = rest - np.repeat(ends[:-1], np.diff(rests))
                listed = pa.StructArray.from_arrays(
                    [found.take(pa.array(rest)), pa.array(places.astype(np.int32))], ["word", "place"])
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:3], _bytes(cls, ends),
                     pa.array(np.add.reduceat((cls != NO_CLASS).astype(np.int64), ends[:-1])),
                     pa.array(np.add.reduceat(logs[part], ends[:-1])),
                     pa.ListArray.from_arrays(pa.array(rests.astype(np.int32)), listed)],
                    ["row", "doc_id", "held_out", "cls", "n_known", "logs", "rest"])

        for b in batches:
            if not b.num_rows:
                continue
            found, lengths = tokens(b.column(3))
            pending.append((b, found, lengths))
            held += len(found)
            if held > LOOKED_UP_AT_ONCE:
                yield from looked_up()
                pending.clear()
                held = 0
        if pending:
            yield from looked_up()

    return run


def frequent_words(words: DataFrame, most: int = FREQUENT) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words, classes and log10(n + 1) of words seen so often that they are at most ``most``.

    The least number of occurrences is read off a histogram of eighths of octaves, so no
    more than ``most`` words come to the driver, from all tasks together. Which these are
    changes no score. The end, which every text has, is always one of them.
    """
    step = F.floor(F.log2("seen") * 8).cast("int")
    sizes = words.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()  # at most 512
    least, total = None, 0
    for r in sorted(sizes, key=lambda r: -r.step):
        total += r.n
        if total >= most:
            break
        least = r.step
    chosen = F.col("word") == F.lit(END)
    if least is not None:
        chosen = chosen | (step >= least)
    found = words.filter(chosen).select("word", "n", F.coalesce("cls", F.lit(NO_CLASS)).alias("cls")).toArrow()
    return (found["word"].cast(pa.binary()).combine_chunks(), found["cls"].to_numpy().astype(np.uint8),
            np.log10(found["n"].to_numpy() + 1.0))


def _filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Class sequences with the classes of words that were joined."""
    for b in batches:
        if not b.num_rows:
            continue
        cls, ends = _flat(b.column(3), np.uint8)
        cls, found = cls.copy(), b.column(6)
        parts = found.flatten().to_numpy()  # the place, and the class in the lowest byte
        starts = np.repeat(ends[:-1], pc.fill_null(found.value_lengths(), 0).to_numpy())
        cls[starts + (parts >> 8)] = parts & 255
        yield pa.RecordBatch.from_arrays([*b.columns[:3], _bytes(cls, ends), *b.columns[4:6]], b.schema.names[:6])


def class_sequences(docs: DataFrame, words: DataFrame) -> DataFrame:
    """(row, doc_id, held_out, cls, n_known, logs): a byte for each token's class. Stored."""
    spark, folder = docs.sparkSession, scratch_folder(docs.sparkSession)
    shared = spark.sparkContext.broadcast(frequent_words(words))
    rows = written(_numbered(docs).mapInArrow(_sequenced(shared), SEQUENCED), folder, "sequenced")
    known = words.filter("n > 0").select("word", "cls", F.log10(F.col("n") + 1).alias("log"))
    rest = rows.select("row", F.inline("rest")).join(known, "word").groupBy("row").agg(
        F.count(F.lit(1)).alias("more_known"), F.sum("log").alias("more_logs"),
        F.collect_list(F.col("place").cast("long") * 256 + F.col("cls")).alias("found"))
    joined = rows.drop("rest").join(rest, "row", "left").select(
        "row", "doc_id", "held_out", "cls", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0))).alias("logs"), "found")
    schema = "row long, doc_id long, held_out boolean, cls binary, n_known long, logs double"
    return written(joined.mapInArrow(_filled, schema), folder, "classed")


def _class_bigrams(start: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(CLASSES * CLASSES, np.int64)
        for b in batches:
            if b.num_rows:  # each text starts after the end of the one before, whose class is the same
                ids = np.concatenate(([start], _flat(b.column(0), np.uint8)[0]))
                found += np.bincount(ids[:-1] * CLASSES + ids[1:], minlength=len(found))
        cells = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(found[cells])], ["cell", "n"])

    return run


def score(cls: np.ndarray, ends: np.ndarray, step: np.ndarray, share: np.ndarray, start: int) -> np.ndarray:
    """log10 probability of each text's classes, without its words' log10(n + 1)."""
    starts = ends[:-1] + np.arange(len(ends) - 1)  # of the texts, each behind a first end of its own
    ids = np.insert(cls.astype(np.int64), ends[:-1], start)
    likeliest = (step - share).argmax(axis=1)
    for i in np.flatnonzero(ids == NO_CLASS).tolist():  # unknown words
        ids[i] = likeliest[ids[i - 1]]
    found = np.concatenate(([0.0], step[ids[:-1], ids[1:]] - share[ids[1:]]))
    found[starts] = 0
    return np.add.reduceat(found, starts)


def _scorer(step: np.ndarray, share: np.ndarray, start: int, base: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            cls, ends = _flat(b.column(3), np.uint8)
            logs, size = b.column(5).to_numpy(), np.diff(ends).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(1), b.column(2), pa.array(size), b.column(4), pa.array(logs - size * base),
                 pa.array(logs + score(cls, ends, step, share, start))],
                ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return run


def scored(docs: DataFrame, others: bool = False) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, base_score, score, train_tokens, perplexity)."""
    words = classed_words(docs, word_counts(docs), others)
    sizes = words.filter("n > 0").groupBy("cls").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    tokens_of, words_of = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in sizes:  # one row per class
        tokens_of[r.cls], words_of[r.cls] = r.n, r.v
    total, distinct = int(tokens_of.sum()), int(words_of.sum())
    end = words.filter(F.col("word") == F.lit(END)).filter("n > 0").select("cls").first()
    start = end.cls if end else 0
    sequences = class_sequences(docs, words)
    learned = sequences.filter("NOT held_out").select("cls")
    b = _matrix(learned.mapInArrow(_class_bigrams(start), "cell int, n long"), CLASSES) + DELTA
    step = np.log10(b / b.sum(1, keepdims=True))
    share = np.log10(tokens_of + words_of + 1)  # an added one per word, and one for the unknown
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    scores = sequences.mapInArrow(_scorer(step, share, start, float(np.log10(total + distinct + 1))), schema)
    return scores.withColumn("train_tokens", F.lit(total).cast("long")).withColumn(
        "perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def op9_classlm(spark: SparkSession, folder: str) -> DataFrame:
    return scored(table(spark, folder, "documents"), others=True)
