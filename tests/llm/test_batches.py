import random

import pytest

from casewatch.llm import decontam, line_dedup, ngram_join, packing
from casewatch.llm.common import BATCH_BYTES, BATCH_SETTING


@pytest.mark.parametrize("module, work", [(decontam, decontam.build_index), (line_dedup, line_dedup.dedup_lines), (ngram_join, ngram_join.near_duplicates), (packing, packing.pack)])
def test_workers_get_small_batches_of_texts(spark, monkeypatch, tmp_path, module, work):
    def watched(run):
        def watch(batches):
            def each():
                for batch in batches:
                    with open(f"{tmp_path}/sizes", "a") as f:
                        f.write(f"{batch.nbytes}\n")
                    yield batch

            yield from run(each())

        return watch

    monkeypatch.setattr(module, "trimmed", watched)
    rng = random.Random(1)
    words = [f"w{i}" for i in range(5000)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(400))) for i in range(2000)]
    rows.append((2000, rows[0][1] + " more"))  # near copies, whose sets meet in cells
    before = spark.conf.get(BATCH_SETTING, None)
    work(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).count()
    sizes = [int(x) for x in (tmp_path / "sizes").read_text().split()]
    assert sum(sizes) > 3 * BATCH_BYTES and max(sizes) < 2 * BATCH_BYTES
    assert spark.conf.get(BATCH_SETTING, None) == before


def test_words_of_phrases_reach_the_tasks_without_python(spark, capsys):
    index = decontam.build_index(spark.createDataFrame([(1, "one two three")], "doc_id long, text string"))
    found = decontam.search(index, iter([("p", (b"one", b"two"))]))
    found.explain()
    assert "ExistingRDD" not in capsys.readouterr().out
    assert [tuple(r)[1:] for r in found.collect()] == [(0, "p", 0, 2)]
