import random

from casewatch.llm import common, line_dedup
from casewatch.llm import ngram_join as J
from casewatch.sources import files


def test_small_tables_get_few_files(spark, monkeypatch):
    """However many tasks make them: every file costs the task that writes it processes that begin as copies of the executor."""
    written = {}

    def counted(df, path, *rest, write=files.write_table):
        write(df, path, *rest)
        written.setdefault(path.rsplit("/", 1)[1].rsplit("-", 1)[0], []).append(len(spark.read.parquet(path).inputFiles()))

    monkeypatch.setattr(files, "write_table", counted)
    monkeypatch.setattr(common, "write_table", counted)
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "40"}
    before = {k: spark.conf.get(k) for k in settings}
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words, k=40)) for _ in range(120)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, t + " end") for i, t in enumerate(texts)]
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = J.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: i % 1000 for i, _ in rows}
    assert {"classes", "lists", "mixed", "cells", "possible", "links", "edges", "roots", "components"} <= written.keys()
    assert max(n for name in written.keys() - {"frequent", "shared", "sets", "keys", "whole"} for n in written[name]) <= 8


def test_ranks_keep_their_order(spark):
    """The ranks of a small table are numbers of the sorted one."""
    pairs = spark.createDataFrame([(i % 50, i % 7) for i in range(700)], "a long, b long").repartition(16)
    got = sorted(line_dedup.ranked(pairs, "a", "b", rows=700).collect(), key=lambda r: r["rank"])
    assert len(got) == 350 and [(r["a"], r["b"]) for r in got] == sorted((r["a"], r["b"]) for r in got)


def test_tables_of_unknown_size_are_written_as_they_come(spark):
    rows = spark.range(0, 1000, 1, 20)
    assert len(files.stored(rows, "unknown").inputFiles()) == 20
    assert len(files.stored(rows, "large", files.SMALL + 1).inputFiles()) == 20
    small = files.stored(rows, "small", 1000)
    assert len(small.inputFiles()) <= 8 and sorted(r["id"] for r in small.collect()) == list(range(1000))
    assert files.stored(rows.limit(0), "empty", 0).count() == 0
