"""The pipeline against a brute-force version, on a table with all odd cases, and on an empty one."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from tests.compare import mismatch, oracle_connection
from vaultloom.llm import queries
from vaultloom.llm.packing import LENGTHS

SMALL = "/root/testdata/sf0.001"
# names that the operators use themselves
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row string, d string, l string, "
          "h1 string, fp string, gone string, w string, _bad1 string, _text string, letters string, place string")
EXTRA = SCHEMA.count(",") - 4
ITEM = " ".join(f"item{i}" for i in range(60))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    words = {"en": "the and of with tion house water green".split(), "de": "der und die mit keit haus wasser grün".split()}
    made = [(lang, " ".join(rng.choice(words[lang]) for _ in range(rng.randint(30, 150)))) for lang in ("en", "de") * 20]
    shared = "\n".join(f"shared line {i}" for i in range(4))
    odd = [made[0], made[0], made[7], ("en", None), (None, made[5][1] + "\nlast"), ("en", ""), ("de", "  \n\t "), ("en", "1 2 3"),
           ("en", "x"), ("en", shared + "\nhere one"), ("de", "before\n" + shared), ("en", "\n".join(["r", "s", "t"] * 4)),
           ("en", made[3][1] + " " + ITEM + " " + made[4][1]), ("de", ITEM.replace("item30 ", "other ").upper()),
           ("en", "only " + ITEM[:200]), (None, None),
           ("en", " ".join(rng.choice(words["en"]) + str(i % 977) for i in range(60_000)))]
    found = [(i, text, lang, "s", 1, *["x"] * EXTRA) for i, (lang, text) in enumerate([*made, *odd])]
    return [*found, found[3], (None, made[9][1], None, None, None, *[None] * EXTRA), (None, None, None, None, None, *[None] * EXTRA)]


def brute_lines(rows):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    seen, out = set(), list(rows)
    for i in order:
        lines = rows[i][1].split("\n")
        gone = set()
        for at in range(len(lines) - 2):
            if tuple(lines[at:at + 3]) in seen:
                gone |= {at, at + 1, at + 2}
            seen.add(tuple(lines[at:at + 3]))
        out[i] = (rows[i][0], "\n".join(x for k, x in enumerate(lines) if k not in gone), *rows[i][2:])
    return out


def brute_fingerprint(text):
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_near(rows):
    fps, kept, left = [brute_fingerprint(r[1]) for r in rows], [], set(range(len(rows)))
    while left:
        group = todo = {left.pop()}
        while todo:
            todo = {j for j in left for i in todo if (fps[i] ^ fps[j]).bit_count() <= 2}
            left -= todo
            group = group | todo
        kept.append(min(group, key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i)))
    return [rows[i] for i in sorted(kept)]


def brute_clean(rows, items):
    def bad(words, item):
        n = min(5, len(item))
        want = Counter(tuple(item[i:i + n]) for i in range(len(item) - n + 1))
        for at in range(max(1, len(words) - len(item) + 1)):
            part = words[at:at + len(item)]
            got = Counter(tuple(part[i:i + n]) for i in range(len(part) - n + 1))
            if got and sum((got & want).values()) >= 0.8 * sum((got | want).values()):
                return True
        return False

    items = [(t or "").lower().split() for t in items]
    return [r for r in rows if not any(i and set(i) & set(r[1].lower().split()) and bad(r[1].lower().split(), i) for i in items)]


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string").coalesce(1).write.parquet(
        f"{path}/benchmark.parquet")
    return path


def test_stages_equal_brute_force(spark, rows, folder):
    want = [r for r in rows if any(map(str.isalpha, r[1] or ""))]
    after = {"language_id": want, "line_dedup": (want := brute_lines(want)), "near_duplicates": (want := brute_near(want)),
             "decontamination": (want := brute_clean(want, [ITEM, None, ""]))}
    assert len({len(x) for x in after.values()}) == 3  # all but line dedup drop rows
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        done = stage(spark, docs, folder)
        assert done.columns == docs.columns, name
        path = f"{folder}/after_{name}"
        done.write.parquet(path)
        docs = spark.read.parquet(path)
        assert Counter(tuple(r) for r in docs.collect()) == Counter(after[name]), name
    words, bins, ends = Counter(), Counter(), {}
    for r in corpus_pipeline.run(spark, folder).collect():
        words[r.doc_id] += r.piece_words
        if r.bin_id is not None:
            bins[r.bin_id] += r.piece_words
            ends[r.bin_id] = r.bin_length
    expected = Counter()
    for r in want:
        expected[r[0]] += len(r[1].split())
    assert words == expected
    assert all(ends[b] == min(c for c in LENGTHS if c >= n) for b, n in bins.items())


def test_pipeline_of_no_rows(spark, rows, tmp_path):
    for name, schema in (("documents", SCHEMA), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "near_duplicates", "decontamination", "packing"]


@pytest.mark.parametrize("name", sorted(queries.llm_oracles()))
def test_query_equals_sql(spark, name):
    assert mismatch(queries.llm_queries()[name](spark, SMALL), oracle_connection(SMALL), queries.llm_oracles()[name]) is None


def test_held_out(spark):
    """Held-out documents: languages are found, and classes score better than single words."""
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    held = [r for r in queries.llm_queries()["op6_langid"](spark, SMALL).collect() if r.held_out and lang[r.doc_id]]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.9 * len(held) > 0
    scored = [r for r in queries.llm_queries()["op9_classlm"](spark, SMALL).collect() if r.held_out]
    assert scored and sum(r.score for r in scored) > sum(r.base_score for r in scored)
