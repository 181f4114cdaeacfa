"""The language stage where nothing can be learned from."""

from vaultloom.llm import stages


def test_unlabelled_table_keeps_its_rows(spark):
    rows = [(1, "the house", None), (2, "über", None), (3, "1 2 3", None), (4, "", None), (5, None, None), (None, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = stages.language_id(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(got.collect(), key=str) == sorted((r for r in docs.collect() if r.doc_id in (None, 1, 2)), key=str)


def test_what_is_in_no_one_language_goes(spark, monkeypatch):
    texts = {"en": "the house and the garden are open today ", "ru": "это большой дом и зелёный сад "}
    rows = [(i, texts[lang] * 8, lang) for i in range(200) for lang in [("en", "ru")[i % 2]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    scores = {r.doc_id: r.score for r in stages.langid.predicted(docs).collect()}
    assert min(scores.values()) >= stages.LEAST_SCORE
    assert stages.language_id(spark, docs, "").count() == 200
    least = sorted(scores.values())[100]
    monkeypatch.setattr(stages, "LEAST_SCORE", least)
    got = {r.doc_id for r in stages.language_id(spark, docs, "").collect()}
    assert got == {i for i, score in scores.items() if score >= least} and len(got) < 200
