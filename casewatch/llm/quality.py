"""Quality rules whose cutoffs control the risk of rejecting good documents.

Each rule rejects documents whose figure, a whole number per thousand words, lines or letters,
reaches a cutoff. The cutoffs to choose from are fixed beforehand. For each stratum, rule and cutoff
the labelled documents give the number of good ones that would be rejected; the cutoff is admitted if
an exact binomial test rules out a false-rejection rate of ``LIMIT`` or more at level ``LEVEL``,
divided by the number of all tests (Bonferroni). So with probability 1 - LEVEL all admitted
cutoffs keep the limit at once, whichever is chosen. Of the admitted ones that catch bad documents, the one with the
best balance is taken, the most lenient among equals; without an admitted one the rule rejects nothing there.

A document goes if any rule fails, so the rules of a stratum are then tested together by the same test of the good
documents that the union rejects, at ``LEVEL`` divided by the number of all combinations of cutoffs that catch a bad
document. That number does not depend on the good ones, so with probability 1 - LEVEL no stratum rejects ``LIMIT``
of them or more, whatever was chosen. The rules of least balance are left out until the others pass.

Cases: null and empty texts have no words and fail the base rule; repeated rows are judged each;
several labels of a document count as one, good only if all are; labels without document or value count nothing;
without labels there are no cutoffs. Strata are languages by length; a null language is a stratum.
Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewatch.llm.common import materialised, table, text_of

SYMBOLS = "#*$%&|<>"
#: Figure of each rule, and the cutoffs it may have.
RULES = {
    "symbols": ("1000 * n_symbols", "n_words", (10, 20, 50, 100, 200, 300, 400, 600, 800, 1000)),
    "repeats": ("1000 * n_repeat_words", "n_words", (20, 40, 60, 80, 100, 120, 140, 160, 180)),
    "dup_lines": ("1000 * n_dup_lines", "n_lines", (50, 100, 150, 200, 250, 300, 400, 500)),
    "capitals": ("1000 * n_capitals", "n_capitals + n_small", (100, 150, 200, 250, 300, 400, 500, 600, 800)),
    "long_words": ("1000 * word_chars", "n_words", (8000, 9000, 10000, 12000, 15000, 20000)),
}
LENGTHS = (200,)
LIMIT, LEVEL = 0.02, 0.05
#: Bad documents that a rule must catch for each good one it rejects.
WORTH = 10

FEATURES = (
    "doc_id long, stratum string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, n_lines long, n_capitals long, n_small long"
)


def repeated_words(words: list[list[bytes]]):
    """For each text, how many of its words lie in 5-word windows found twice or more in it."""
    import numpy as np
    import pandas as pd

    lengths = np.array([len(w) for w in words], np.int64)
    total = np.zeros(len(words), np.int64)
    ids: dict[bytes, int] = {}
    flat = np.fromiter((ids.setdefault(w, len(ids)) for text in words for w in text), np.uint64, int(lengths.sum()))
    if len(flat) < 5:
        return total
    doc = np.repeat(np.arange(len(words)), lengths)
    spread = (flat + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    spread ^= spread >> np.uint64(29)
    key = doc[:-4].astype(np.uint64)
    for k in range(5):
        key = (key ^ (key >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9) + spread[k : len(spread) - 4 + k]
    inside = doc[:-4] == doc[4:]
    codes, _ = pd.factorize(key[inside])
    twice = np.bincount(codes)[codes] > 1
    begin = np.flatnonzero(inside)[twice]
    change = np.zeros(len(flat) + 1, np.int64)
    np.add.at(change, begin, 1)
    np.add.at(change, begin + 5, -1)
    covered = np.cumsum(change)[:-1] > 0
    return np.bincount(doc[covered], minlength=len(words))


def _features(batches):
    import numpy as np
    import pyarrow as pa

    white, capitals, small = " \t\n\r\x0b\x0c", bytes(range(65, 91)), bytes(range(97, 123))
    symbols = SYMBOLS.encode()

    def made(ids, langs, texts):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        words = [b.split() for b in raw]
        lines = [[x for x in t.split("\n") if x.strip(white)] for t in texts]
        n = np.array([len(w) for w in words], np.int64)
        size = np.searchsorted(LENGTHS, n, side="right")
        columns = [
            pa.array(ids, pa.int64()),
            pa.array([f"{lang if lang is not None else ''}/{s}" for lang, s in zip(langs, size)]),
            n,
            [len(t) - sum(map(t.count, white)) for t in texts],
            [len(b) - len(b.translate(None, symbols)) for b in raw],
            [len(x) - len(set(x)) for x in lines],
            repeated_words(words),
            [len(x) for x in lines],
            [len(b) - len(b.translate(None, capitals)) for b in raw],
            [len(b) - len(b.translate(None, small)) for b in raw],
        ]
        return pa.RecordBatch.from_arrays(columns[:2] + [pa.array(c, pa.int64()) for c in columns[2:]], [f.split()[0] for f in FEATURES.split(", ")])

    for batch in batches:
        ids, langs, texts = (c.to_pylist() for c in batch.columns)
        begin, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text)
            if size > 1 << 21 or i == len(texts) - 1:
                yield made(ids[begin : i + 1], langs[begin : i + 1], texts[begin : i + 1])
                begin, size = i + 1, 0


def features(docs: DataFrame) -> DataFrame:
    """Stored counts of each document; a row of small numbers for each row of ``docs``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), text_of().alias("text"))
    return materialised(texts.mapInArrow(_features, FEATURES), "features")[0]


def figures() -> list:
    """One column per rule: its figure, rounded down; 0 where nothing is there to divide by."""
    return [F.expr(f"CASE WHEN {below} > 0 THEN ({above}) DIV ({below}) ELSE 0 END").alias(rule) for rule, (above, below, _) in RULES.items()]


def base_failed():
    return F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words")


def binomial_tail(k: int, n: int, p: float) -> float:
    """Probability of at most ``k`` successes in ``n`` trials; 1 where ``k`` is not below the mean."""
    from math import exp, lgamma, log, log1p

    if k >= n * p:
        return 1.0
    term = exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * log(p) + (n - k) * log1p(-p))
    total, i = term, k
    while i > 0 and term > total * 1e-17:
        term *= i * (1 - p) / ((n - i + 1) * p)
        total += term
        i -= 1
    return total


def _admitted(limit: float, level: float):
    def run(frames):
        for frame in frames:
            fine = [binomial_tail(k, n, limit) <= level / tests for k, n, tests in zip(frame["k"], frame["n"], frame["tests"])]
            yield frame[fine]

    return run


def cutoffs(judged: DataFrame, labels: DataFrame, limit: float = LIMIT, level: float = LEVEL) -> DataFrame:
    """stratum, rule, cutoff: what the labelled documents that pass the base rule admit."""
    label = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = judged.filter(~base_failed()).join(label, "doc_id").select("stratum", (F.col("quality") == 1).alias("good"), *figures())
    grid = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(c).cast("long").alias("cutoff"), (F.col(rule) >= c).alias("hit")) for rule, (_, _, cs) in RULES.items() for c in cs])
    cells = known.select("stratum", "good", F.explode(grid).alias("g")).groupBy("stratum", "g.rule", "g.cutoff").agg(
        F.sum((F.col("good") & F.col("g.hit")).cast("long")).alias("k"),
        F.sum(F.col("good").cast("long")).alias("n"),
        F.sum((~F.col("good") & F.col("g.hit")).cast("long")).alias("caught"),
    )
    cells, _ = materialised(cells, "cells")
    fine = cells.withColumn("tests", F.lit(cells.count()).cast("long")).mapInPandas(_admitted(limit, level), "stratum string, rule string, cutoff long, k long, n long, caught long, tests long")
    worth = F.col("caught") - WORTH * F.col("k")
    best = fine.filter(worth > 0).groupBy("stratum", "rule").agg(F.max(F.struct(worth.alias("worth"), F.col("cutoff"))).alias("b"))
    best, _ = materialised(best.select("stratum", "rule", "b.worth", "b.cutoff"), "best")
    return materialised(_together(known, cells, best, limit, level), "cutoffs")[0]


def _leading(limit: float, level: float):
    def run(frames):
        for frame in frames:
            passed = [[binomial_tail(k, n, limit) <= level for k in ks[:size]] for ks, n, size in zip(frame["ks"], frame["n"], frame["size"])]
            yield frame[["stratum"]].assign(leading=[sum(fine) for fine in passed])  # a longer union rejects no fewer

    return run


def _together(known: DataFrame, cells: DataFrame, best: DataFrame, limit: float, level: float) -> DataFrame:
    """stratum, rule, cutoff: of each stratum the rules of the best balance that keep the limit together."""
    choices = cells.filter("caught > 0").groupBy("stratum", "rule").agg((F.count(F.lit(1)) + 1).alias("c")).groupBy("stratum").agg(F.product("c").alias("c"))
    tests = choices.agg(F.sum(F.col("c") - 1)).first()[0] or 1
    ranked = best.groupBy("stratum").agg(F.sort_array(F.collect_list(F.struct("worth", "rule", "cutoff")), asc=False).alias("ranked"))
    figure = F.create_map(*[x for rule in RULES for x in (F.lit(rule), F.col(rule))])
    first = F.array_position(F.transform("ranked", lambda r: F.element_at(figure, r["rule"]) >= r["cutoff"]), F.lit(True))
    good = known.filter("good").join(ranked, "stratum").select("stratum", F.size("ranked").alias("size"), first.alias("first"))
    unions = good.groupBy("stratum", "size").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(F.col("first").between(1, i + 1).cast("long")) for i in range(len(RULES))]).alias("ks")
    )
    leading = unions.mapInPandas(_leading(limit, level / tests), "stratum string, leading int")
    return ranked.join(leading, "stratum").select("stratum", F.explode(F.slice("ranked", F.lit(1), F.col("leading"))).alias("r")).select("stratum", "r.rule", "r.cutoff")


def judge(judged: DataFrame, chosen: DataFrame) -> DataFrame:
    """``judged`` with base_failed, failed_rules and kept."""
    wide = chosen.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))
    rows = judged.select("*", *figures()).join(wide, "stratum", "left")
    failed = F.array_compact(F.array(*[F.when(F.col(rule) >= F.element_at("cutoffs", F.lit(rule)), F.lit(rule)) for rule in RULES]))
    rows = rows.withColumn("base_failed", base_failed()).withColumn("failed_rules", failed)
    return rows.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop("cutoffs", *RULES)


def op5(spark, sf_dir: str) -> DataFrame:
    judged = features(table(spark, sf_dir, "documents"))
    done = judge(judged, cutoffs(judged, table(spark, sf_dir, "labels")))
    return done.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_FIGURES = ", ".join(f"case when {below} > 0 then ({above}) // ({below}) else 0 end as {rule}" for rule, (above, below, _) in RULES.items())
_GRID = ", ".join(f"('{rule}', {c})" for rule, (_, _, cs) in RULES.items() for c in cs)
_FIGURE_OF = "case rule " + " ".join(f"when '{rule}' then {rule}" for rule in RULES) + " end"

OP5_SQL = f"""
with d as (
    select row_number() over () as r, doc_id, coalesce(lang, '') as lang, coalesce(text, '') as t,
        regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w
    from documents
), lines as (
    select r, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
    from (select r, unnest(string_split(t, chr(10))) as line from d) where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by r
), runs as (
    select r, i, array_to_string(w[i : i + 4], ' ') as run from (select r, w, unnest(generate_series(1, len(w) - 4)) as i from d where len(w) >= 5)
), twice as (
    select r, i from (select r, i, count(*) over (partition by r, run) as n from runs) where n > 1
), repeats as (
    select r, count(distinct p) as n_repeat_words from (select r, unnest(generate_series(i, i + 4)) as p from twice) group by r
), f as (
    select d.r, doc_id, lang || '/' || case when len(w) >= {LENGTHS[0]} then 1 else 0 end as stratum,
        cast(len(w) as bigint) as n_words,
        cast(length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) as bigint) as word_chars,
        cast(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) as bigint) as n_symbols,
        coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_lines, 0) as n_lines,
        length(regexp_replace(t, '[^A-Z]+', '', 'g')) as n_capitals, length(regexp_replace(t, '[^a-z]+', '', 'g')) as n_small
    from d left join lines using (r) left join repeats using (r)
), g as (
    select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed, {_FIGURES} from f
), label as (
    select doc_id, min(quality) as quality from labels where doc_id is not null and quality is not null group by doc_id
), cells as (
    select stratum, rule, cutoff, count(*) filter (quality = 1) as n,
        count(*) filter (quality = 1 and {_FIGURE_OF} >= cutoff) as k, count(*) filter (quality <> 1 and {_FIGURE_OF} >= cutoff) as caught
    from (select * from g join label using (doc_id) where not base_failed) cross join (values {_GRID}) as v(rule, cutoff) group by stratum, rule, cutoff
), tested as (
    select *, case when k >= n * {LIMIT} then 1 else list_sum(list_transform(generate_series(0, k), lambda i:
        exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({LIMIT}) + (n - i) * ln(1 - {LIMIT})))) end as tail,
        count(*) over () as tests
    from cells
), chosen as (
    select stratum, rule, max(cutoff) as cutoff from (
        select *, caught - {WORTH} * k = max(caught - {WORTH} * k) over (partition by stratum, rule) as best from tested
        where tail <= {LEVEL} / tests and caught - {WORTH} * k > 0)
    where best group by stratum, rule
), rejected as (
    select distinct r from g join chosen using (stratum) where {_FIGURE_OF} >= cutoff
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and rejected.r is null as kept
from g left join rejected on g.r = rejected.r
"""
