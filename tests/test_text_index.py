import random

import pytest
from pyspark.sql import functions as F

from casewatch.operators import text_index as TI
from casewatch.operators.case_queries import text_search
from casewatch.session import new_table_path
from casewatch.sources import files
from tests.test_scale import input_records

WORDS = "Card card LOAN fraud Füße naïve ATM a.b (x) refund_2 pending ΣΑΣ İstanbul 50% re-open".split()
PATTERNS = [
    "fraud", "FRAUD.*card", "(card|loan) fraud", "re-?open", "car[dt]", "(ab|frau)d", "(fraud){2}", "(?:refund|pend)(ing|_2)?", "füße", "Füße", "ΣΑΣ", "^card", r"\bloan\b",
    "x*", "a.b", "f[rl]aud", "[cC]a[rst][de]", "re[-_]?fund", "[^c]ard", "ca[a-z]d", r"a\.b", r"\(x\)", r"\p{L}+ning", r"\Qa.b\E", "50%", "İstan", "(?=fraud)f", "(?!fraud)card", "zzzz", "card|x", "l(?:o(?:a(?:n)))", r"(card) \1",
]


@pytest.fixture(scope="module")
def index(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 7)))) for i in range(1500)] + [(9000, None), (9001, ""), (9002, "ab"), (9003, "rare needle here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("gram", F.lit("own")).repartition(4)
    path = new_table_path(spark, "index")
    TI.build_index(docs, path)
    return docs, path


@pytest.mark.parametrize("pattern", PATTERNS)
def test_the_same_rows_as_a_full_scan(spark, index, pattern):
    docs, path = index
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(TI.index_search(spark, path, pattern)) == rows(text_search(docs, pattern))


@pytest.mark.parametrize("pattern", ["a.b", "Card", "%", "(x)"])
def test_literal_search(spark, index, pattern):
    docs, path = index
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(TI.index_search(spark, path, pattern, literal=True)) == rows(text_search(docs, pattern, literal=True))


def test_many_candidates_are_joined(spark, index, monkeypatch):
    monkeypatch.setattr(TI, "LOOKED_UP", 3)
    docs, path = index
    assert TI.index_search(spark, path, "fraud").count() == text_search(docs, "fraud").count() > 3


def test_what_a_pattern_needs():
    assert TI.needed_grams("abcd") == ("and", ["abc", "bcd"])
    assert TI.needed_grams("(xabc|def)y") == ("or", [("and", ["xab", "abc"]), "def"])
    assert TI.needed_grams("(ABC)?") is None and TI.needed_grams("abc|x") is None and TI.needed_grams(".*") is None
    assert TI.needed_grams("gh[po]_x") == ("or", [("and", ["ghp", "hp_", "p_x"]), ("and", ["gho", "ho_", "o_x"])])
    assert TI.needed_grams("[^g]hp") is None and TI.needed_grams("g[a-z]p") is None
    assert TI.needed_grams(r"\Qabc\E") is None  # syntax of the JVM only


@pytest.mark.parametrize("text", ["", "ab", "abc", "ABCabc", "Füße ΣΑΣ", "a\n\n\x00b", "\U0001f600\U0010ffff!\U0001f600\U0010ffff!", "xyz" * 50])
def test_grams_are_numbered_without_a_string_each(monkeypatch, text):
    folded = text.translate(TI._FOLD)
    wanted = sorted({(ord(a) << 42) | (ord(b) << 21) | ord(c) for a, b, c in zip(folded, folded[1:], folded[2:])})
    assert TI.gram_numbers(text.encode()).tolist() == wanted
    monkeypatch.setattr(TI, "SLICE", 4)
    assert TI.gram_numbers(text.encode()).tolist() == wanted


def test_the_index_keeps_a_number_for_a_gram(spark, index):
    assert dict(spark.read.parquet(f"{index[1]}/grams").dtypes)["gram"] == "bigint"


def test_a_rare_word_reads_few_rows(spark):
    rng = random.Random(2)
    texts = [(i, " ".join(f"word{rng.randrange(3000)}" for _ in range(30))) for i in range(20_000)] + [(50_000, "here is the needle")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    path = new_table_path(spark, "index")
    TI.build_index(docs, path)
    before = input_records(spark)
    assert [r.doc_id for r in TI.index_search(spark, path, "the needle").collect()] == [50_000]
    grams = spark.read.parquet(f"{path}/grams").count()
    assert input_records(spark) - before - grams < 0.2 * (grams + len(texts))


def test_sorted_files_are_in_order_and_a_month_reads_a_fraction(spark):
    days = spark.range(200_000).select(F.expr("date_add(date'2020-01-01', cast(if(id % 3 = 0, 700, pmod(xxhash64(id), 1800)) as int))").alias("date"), F.col("id"), F.lit("x" * 20).alias("text"))
    path = new_table_path(spark, "sorted")
    files.write_sorted(days, path, ["date"], ["id"], partitions=12, group_bytes=1 << 16)
    back = spark.read.parquet(path)
    bounds = back.groupBy(F.input_file_name().alias("f")).agg(F.min("date"), F.max("date"), F.count("*")).orderBy("f").collect()
    assert len(bounds) == 12 and max(r[3] for r in bounds) < 0.2 * 200_000  # the day with a third of all rows fills several files
    assert all(a[2] <= b[1] for a, b in zip(bounds, bounds[1:]))
    before = input_records(spark)
    month = back.filter("date BETWEEN '2020-03-01' AND '2020-03-31'")
    n = month.select("text").collect()
    assert 0 < len(n) <= input_records(spark) - before < 0.2 * 200_000
