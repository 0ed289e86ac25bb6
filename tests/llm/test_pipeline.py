"""The pipeline as a whole on odd rows, and each stage's decisions on what its predecessor kept."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from basketry.llm import languages, ngram_join, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _row string, features int, score string, body string"
ENGLISH = "the house near river has many old trees and people walk there every day with their dogs and children".split()
GERMAN = "das haus am fluss hat viele alte bäume und die leute gehen dort jeden tag mit ihren hunden und kindern".split()
INSULTS = "zork blargh fnord".split()


def made(seed: int, count: int):
    """Documents with labels: half of each language, every fifth toxic."""
    random_ = random.Random(seed)
    rows, labels = [], []
    for k in range(count):
        words = [random_.choice(ENGLISH if k % 2 else GERMAN) + ("" if random_.random() < 0.7 else str(random_.randrange(50))) for _ in range(random_.randrange(30, 400))]
        toxic = k % 5 == 0
        if toxic:
            for _ in range(12):
                words.insert(random_.randrange(len(words)), "you " + random_.choice(INSULTS))
        rows.append((k, " ".join(words), "en" if k % 2 else "de", "src0"))
        labels.append((k, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rows, labels = made(1, 400)
    near = rows[3][1] + " end"
    odd = [
        (1000, None, "en", None),
        (1001, "", None, "src1"),
        (1002, " \t", "en", "src1"),
        (1003, near, "en", "src1"),
        (1004, rows[3][1], "en", None),
        (None, rows[7][1], "en", "src2"),
        (1005, " ".join(ENGLISH * 4000), "en", "src2"),
        (1006, rows[9][1] + " one two three four five six seven eight nine ten eleven", "en", "src2"),
    ]
    extra = ("x", 1, "y", "z")
    frame = spark.createDataFrame([(*row, len(row[1] or ""), *extra) for row in rows + odd], DOCS)
    frame.repartition(3).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    items = [("b1", "One two three four five six seven eight nine ten"), ("b2", None), ("b3", "")]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path)


def test_stages_follow_each_other(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept, columns = {}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = {row.doc_id for row in docs.select("doc_id").collect()}
        if name != "sentencepiece_encoding":
            assert docs.columns == columns
    order = [kept[name] for name, _ in corpus_pipeline.STAGES]
    assert all(after <= before for before, after in zip(order, order[1:], strict=False))
    toxic = set(range(0, 400, 5))
    assert len(kept["toxicity"] & toxic) <= 4 and len(kept["toxicity"] - toxic) >= 320
    # without letters there is no language
    assert not kept["language_id"] & {1000, 1001, 1002} and {1003, 1004, 1005} <= kept["language_id"]
    assert not kept["ngram_jaccard_join"] & {1003, 1004} and 3 in kept["ngram_jaccard_join"]
    # a document without an id is in no group
    assert None in kept["ngram_jaccard_join"]
    assert kept["ngram_jaccard_join"] - kept["benchmark_decontamination"] <= {1006}
    assert 1006 not in kept["benchmark_decontamination"]
    assert docs.filter("NOT round_trip").count() == 0 and docs.count() == len(kept["benchmark_decontamination"])
    whole = corpus_pipeline.run(spark, folder)
    assert {row.doc_id for row in whole.select("doc_id").collect()} == kept["sentencepiece_encoding"]


def test_stages_keep_rows_as_they_are(spark, folder):
    """Only the text goes to Python; rows that stay are untouched, and scores are those of the operators."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    scores = {row.doc_id: row.score for row in toxicity.score_texts(docs, model).collect()}
    clean = toxicity.keep_clean(docs, model)
    wanted = sorted((tuple(row) for row in docs.collect() if scores[row.doc_id] < 0.5), key=str)
    assert sorted((tuple(row) for row in clean.collect()), key=str) == wanted
    known = languages.train(docs)
    found = {row.doc_id: row.lang_pred for row in languages.identify(docs, known).collect()}
    wanted = sorted((tuple(row) for row in docs.collect() if found[row.doc_id] != "und"), key=str)
    assert sorted((tuple(row) for row in languages.keep_identified(docs, known).collect()), key=str) == wanted
    for kept in (clean, languages.keep_identified(docs, known)):
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "ArrowEvalPython" in plan and "MapInArrow" not in plan


def test_pipeline_of_nothing(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_one_of_each_with_clashing_columns_and_repeated_ids(spark):
    rows = [(1, "a b c d e f", 1, 2), (1, "a b c d e", 3, 4), (2, "x y z u v w", 5, 6), (3, "x y z u v w", 7, 8), (None, "x y z u v w", 9, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _going int, _twice int")
    kept = {tuple(row) for row in ngram_join.keep_one(docs).collect()}
    assert kept == {rows[1], rows[2], rows[4]}
    # a column that is named like the operator's own
    named = docs.withColumnsRenamed({"_going": "key", "_twice": "row"})
    assert {tuple(row) for row in ngram_join.keep_one(named).collect()} == kept
