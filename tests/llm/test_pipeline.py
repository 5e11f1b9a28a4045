import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from casewatch.llm.common import materialised, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """The smallest documents and some of known fate."""
    rng = random.Random(1)
    words = [w for r in table(spark, SF, "documents").filter("lang = 'en'").limit(20).collect() for w in r["text"].split()]
    make = lambda n: " ".join(rng.choice(words) for _ in range(n))
    item = table(spark, SF, "benchmark").first()["text"]
    passage, base = make(60), make(150)
    changed = base.split()
    changed[70] = "changedword"
    rows = {
        9000: base, 9001: base, 9002: " ".join(changed), 9003: make(20) + "\n" + passage, 9004: make(25) + "\n" + passage + "\n" + make(9),
        9005: item, 9006: make(30) + " " + item + " " + make(30), 9007: None, 9008: "", 9009: "123 456", 9010: make(200), 9011: make(3),
    }
    made = spark.createDataFrame([(i, t, "en", "planted", len(t or "")) for i, t in rows.items()], "doc_id long, text string, lang string, source string, n_chars long")
    out = str(tmp_path_factory.mktemp("planted"))
    table(spark, SF, "documents").unionByName(made).write.parquet(f"{out}/documents.parquet")
    table(spark, SF, "benchmark").write.parquet(f"{out}/benchmark.parquet")
    return out, passage


def test_stages_decide_and_keep_columns(spark, planted):
    out, passage = planted
    docs, ids = table(spark, out, "documents"), {}
    for name, stage in C.STAGES[:-1]:
        docs, _ = materialised(stage(spark, docs, out), name)
        assert tuple(docs.columns) == C.COLUMNS
        ids[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    plain = {r["doc_id"] for r in table(spark, SF, "documents").collect()}
    assert {9007, 9008, 9009}.isdisjoint(ids["language_id"]) and len(ids["language_id"].keys() & plain) >= 0.99 * len(plain)
    lines = ids["line_dedup"]
    assert passage in lines[9003] and passage not in lines[9004] and lines[9004].count("\n") == 1
    assert 9001 not in lines  # an exact copy loses all its lines
    assert lines[9010] == ids["language_id"][9010] and {9000, 9010, 9011} <= ids["ngram_join"].keys()
    assert 9002 not in ids["ngram_join"] and 9002 in lines
    assert {9005, 9006}.isdisjoint(ids["decontamination"]) and {9000, 9010, 9011} <= ids["decontamination"].keys()
    packed = C.STAGES[-1][1](spark, docs, out)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == ids["decontamination"].keys()


def test_rows_without_id_and_repeated_rows(spark, planted):
    out, _ = planted
    rows = [(None, "a b c d e f g", "en", None, 13), (None, "a b c d e f g", "en", None, 13), (None, "h i j k l m n", "en", None, 13), (1, "a b c d e f g", "en", None, 13), (2, None, "en", None, None), (2, None, "en", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = C.one_of_near_duplicates(spark, docs, out).collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in kept) == [("1", "a b c d e f g"), ("2", "None"), ("2", "None"), ("None", "h i j k l m n")]
    assert C.without_benchmarks(spark, docs, out).count() == 6
    cut = C.without_repeated_lines(spark, docs.withColumn("text", F.repeat("text", 20)), out)
    assert cut.count() == 4


def test_empty_documents(spark, planted):
    out, _ = planted
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in C.STAGES:
        docs, _ = materialised(stage(spark, docs, out), "empty")
    assert docs.count() == 0
