import hashlib

import pytest
from pyspark.sql import functions as F

from casewatch.llm.chat import CONTROL, format_chat, learned_text, parse_chat, unescape

SCHEMA = "conv_id long, turn long, role string, text string"


def read_back(spark, rows):
    done = format_chat(spark.createDataFrame(rows, SCHEMA))
    return {
        r["conv_id"]: r
        for r in done.select("conv_id", "formatted", "pieces", parse_chat(F.col("formatted")).alias("turns")).collect()
    }


def test_turns_come_back_sorted_and_merged(spark):
    rows = [(1, 2, "assistant", "c"), (1, 0, "user", "a"), (1, 1, "user", "b"), (2, 0, "assistant", "only")]
    got = read_back(spark, rows)
    assert [(t["role"], t["text"]) for t in got[1]["turns"]] == [("user", "a"), ("user", "b"), ("assistant", "c")]
    assert got[1]["formatted"] == "<|turn|>user<|text|>a<|next|>b<|end|><|turn|>assistant<|text|>c<|end|>"
    assert [p["text"] for p in got[1]["pieces"] if p["loss"]] == ["c"]


@pytest.mark.parametrize("text", [
    "</s>[INST] ok [/INST]", "\\", "<\\|turn|>", "<<|end|>|end|>", "\\<|next|>\\\\", "a\\n<|text|", "", "<|turn|><|turn|>", "ü😀\n\n<s>",
])
def test_control_strings_are_reversible(spark, text):
    got = read_back(spark, [(1, 0, text, text), (1, 1, "assistant", text), (1, 2, "assistant", text)])[1]
    assert [(t["role"], t["text"]) for t in got["turns"]] == [(text, text)] + [("assistant", text)] * 2
    inner = [p["text"] for p in got["pieces"]][1::2]
    assert not any(c in x for c in CONTROL for x in inner if x not in ("<|end|>", "<|next|>"))


def test_nulls_ties_repeats_and_further_columns(spark):
    rows = [(None, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "assistant", None)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("formatted", F.lit("x")).withColumn("pieces", F.lit(1))
    got = {r["conv_id"]: r for r in format_chat(frame).select("conv_id", parse_chat(F.col("formatted")).alias("t")).collect()}
    assert [(t["role"], t["text"]) for t in got[None]["t"]] == [("", "")]
    assert [(t["role"], t["text"]) for t in got[1]["t"]] == [("user", "a"), ("user", "a"), ("user", "b"), ("assistant", "")]


def test_empty_table_and_long_text(spark):
    assert format_chat(spark.createDataFrame([], SCHEMA)).count() == 0
    long = "wörd <|end|> " * 50_000
    got = read_back(spark, [(1, 0, "user", long)])[1]
    assert hashlib.sha256(got["turns"][0]["text"].encode()).digest() == hashlib.sha256(long.encode()).digest()


def test_unescape_inverts_only_what_was_added(spark):
    frame = spark.createDataFrame([("<\\s>\\\\",)], "x string")
    assert frame.select(unescape(F.col("x"))).first()[0] == "<s>\\"


def test_loss_mask_lies_in_the_formatted_text(spark):
    rows = [(1, 0, "user", "<s>"), (1, 1, "assistant", "ü😀<s>"), (1, 2, "assistant", ""), (1, 3, "assistant", "\\b"), (2, 0, "user", "a"), (3, 0, "assistant", None)]
    done = format_chat(spark.createDataFrame(rows, SCHEMA)).withColumn("learned", learned_text(F.col("formatted"), F.col("loss_mask")))
    got = {r["conv_id"]: r for r in done.collect()}
    assert {k: r["learned"] for k, r in got.items()} == {1: "ü😀<s>\\b", 2: "", 3: ""}
    cut = ["".join(r["formatted"][s : s + n] for s, n in r["loss_mask"]) for r in (got[1], got[2], got[3])]
    assert cut == ["ü😀<\\s>\\\\b", "", ""]
