"""Secret scanning with a trigram inverted index, in Spark expressions only.

Every rule's pattern is parsed on the driver and gives a Boolean query: the trigrams, in lower case, of each run of literals that a match
must contain, AND-ed, and OR-ed over alternatives and the members of small classes. ``postings`` lists, for blocks of documents, the
documents that contain each trigram of the queries; ``candidates`` intersects and unites the lists. Only
candidates are searched with the pattern. A rule whose pattern has no mandatory trigram searches every text.

Documents are known by id and text hash, so copies of a row share their result. Cases: null texts are
empty and have no spans; repeated rows are returned each; ties at one start are in the order of the
rules; an empty table gives no rows. Further columns are ignored by ``scan``.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewatch.llm.common import stored, table, text_of
from casewatch.operators.text_index import needed_grams


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` are taken from the left without overlap; those whose ``group`` has fewer than ``least`` characters are dropped.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The three base kinds and their order.
BASE = (
    Rule(
        "assign", "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2, 6,
    ),
    Rule("access", "AKIA[A-Z0-9]+", least=20),
    Rule("hex", "[0-9a-f]+", least=24),
)
#: Further kinds, by the public formats of such keys.
MORE = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("jwt", "eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", least=30),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("google", "AIza[A-Za-z0-9_-]+", least=39),
    Rule("stripe", "[sr]k_live_[A-Za-z0-9]+", least=20),
)
RULES = BASE + MORE
#: Documents in a block of the index, about.
BLOCK = 4096


def _options(condition) -> list[list[str]]:
    if isinstance(condition, str):
        return [[condition]]
    parts = [_options(part) for part in condition[1]]
    if condition[0] == "or":
        return list(itertools.chain(*parts))
    return [sorted(set(itertools.chain(*chosen))) for chosen in itertools.product(*parts)]


def trigrams(rule: Rule) -> list[list[str]]:
    """Alternatives (OR) of trigrams (AND) that the pattern's matches hold, in lower case; none: no mandatory trigram."""
    condition = needed_grams(rule.pattern)
    return [] if condition is None else _options(condition)


def vocabulary(rules: tuple[Rule, ...]) -> list[str]:
    """Trigrams of all queries."""
    return sorted({t for rule in rules for t in itertools.chain(*trigrams(rule))})


def keyed(docs: DataFrame, blocks: int = 1) -> DataFrame:
    """doc_id, text, and the key by which both are known."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    texts = texts.withColumn("key", F.struct("doc_id", F.xxhash64("text").alias("hash"), F.length("text").alias("size")))
    return texts.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))


def postings(texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Inverted index: block, trigram, and the keys of the block's documents that contain it."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")  # A-Z only, so that one character stays one
    low = texts.select("block", "key", lowered.alias("low"))
    held = F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in vocabulary(rules)])
    there = low.select("block", "key", F.explode(F.array_compact(held)).alias("trigram"))
    return there.groupBy("block", "trigram").agg(F.collect_set("key").alias("keys"))


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """key, kinds: for each document the rules whose query it answers."""
    per_block = index.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "keys"))).alias("lists"))
    nothing = F.array().cast(index.schema["keys"].dataType)
    held = []
    for rule in rules:
        if not trigrams(rule):
            continue
        lists = lambda t: F.coalesce(F.element_at("lists", F.lit(t)), nothing)
        options = [reduce(F.array_intersect, [lists(t) for t in option]) for option in trigrams(rule)]
        kind = F.lit(rule.kind).alias("kind")
        held.append(F.transform(reduce(F.array_union, options), lambda k: F.struct(k.alias("key"), kind)))  # noqa: B023
    found = per_block.select(F.explode(F.concat(*held)).alias("c"))
    return found.groupBy("c.key").agg(F.collect_set("c.kind").alias("kinds"))


def spans_of(rule: Rule, text: Column) -> Column:
    """Array of (start, rank, kind, end) of the pattern's matches, in code points.

    The pieces between the matches and the matches follow each other, so their lengths add up to the places.
    """
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    groups = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    gaps = F.transform(F.split(text, rule.pattern, -1), F.char_length)
    parts = F.zip_with(F.zip_with(matches, groups, lambda m, g: F.struct(F.char_length(m).alias("size"), F.char_length(g).alias("n"))), F.slice(gaps, F.lit(1), F.size(matches)), lambda m, gap: F.struct(gap.alias("gap"), m["size"].alias("size"), m["n"].alias("n")))
    empty = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
    summed = F.aggregate(
        parts,
        F.struct(F.lit(0).alias("at"), empty.alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + p["gap"] + p["size"]).alias("at"),
            F.when(
                p["n"] >= rule.least,
                F.concat(acc["spans"], F.array(F.struct(
                    (acc["at"] + p["gap"]).alias("start"), F.lit(_rank(rule)).alias("rank"), F.lit(rule.kind).alias("kind"), (acc["at"] + p["gap"] + p["size"]).alias("end"),
                ))),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
    )["spans"]
    return summed


def _rank(rule: Rule) -> int:
    return [r.kind for r in RULES].index(rule.kind) if rule in RULES else len(RULES)


def quick(rule: Rule) -> str:
    """A pattern that finds whether there is a match long enough, for rules that are one run of characters."""
    return rule.pattern[:-1] + f"{{{rule.least},}}" if rule.pattern.endswith("]+") and rule.pattern.count("[") == 1 and rule.pattern[0] == "[" else rule.pattern


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, text, spans: array of (start, rank, kind, end), by start and then in the order of the rules."""
    blocks = max(1, docs.count() // BLOCK)
    texts = keyed(docs, blocks)
    found = stored(candidates(postings(texts, rules), rules), "candidates")  # of known size: few are sent to the texts
    joined = texts.drop("block").join(found, "key", "left")
    nothing = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
    spans = []
    for rule in rules:
        wanted = F.array_contains("kinds", rule.kind) if trigrams(rule) else F.rlike("text", F.lit(quick(rule)))
        spans.append(F.when(wanted, spans_of(rule, F.col("text"))).otherwise(nothing))
    return joined.select("doc_id", "text", F.array_sort(F.concat(*spans)).alias("spans"))


def joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op7(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    return found.select(
        "doc_id",
        *[F.size(F.filter("spans", lambda s: s["kind"] == r.kind)).cast("long").alias(f"n_{r.kind}") for r in BASE],  # noqa: B023
        F.sha2(joined_spans(base), 256).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"),
    )


def _sql_part(i: int, rule: Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    group = f"regexp_extract_all(t, '{pattern}', {rule.group})"
    return f"""
    select r, {i} as rank, '{rule.kind}' as kind, list_sum(list_transform(g[1 : i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1 : i - 1], lambda x: length(x))), 0) as start,
        length(m[i]) as size, length(v[i]) as n, {rule.least} as least
    from (select r, m, v, g, unnest(generate_series(1, len(m))) as i from (
        select r, regexp_extract_all(t, '{pattern}') as m, {group} as v, regexp_split_to_array(t, '{pattern}') as g from d))
    where length(v[i]) >= {rule.least}"""


OP7_SQL = f"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
spans as ({' union all '.join(_sql_part(i, rule) for i, rule in enumerate(RULES))}),
written as (select *, kind || ':' || cast(start as bigint) || ':' || cast(start + size as bigint) as s from spans),
per_doc as (
    select r, {', '.join(f"count(*) filter (kind = '{rule.kind}') as n_{rule.kind}" for rule in BASE)},
        string_agg(s, ',' order by start, rank) filter (rank < {len(BASE)}) as base, string_agg(s, ',' order by start, rank) as spans
    from written group by r
)
select doc_id, {', '.join(f"coalesce(n_{rule.kind}, 0) as n_{rule.kind}" for rule in BASE)}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join per_doc using (r)
"""
