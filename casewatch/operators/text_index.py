"""Regular-expression search through a stored index of three-character strings.

The index holds one row per document and distinct gram of its text (letters A to Z in lower case; a gram is one number, 21 bits a
character), dealt out and sorted by gram, and a copy of the texts sorted by id; so a search reads the row groups of the grams it needs, and of the documents that may match.
From the pattern follows which grams every match must hold: runs of literals, all of them; alternatives and small classes of characters, those of one of them. Candidates
are checked by the pattern itself. A pattern without such grams, or with syntax that only the JVM knows, scans all texts.
"""

from __future__ import annotations

import re
import string
from re import _constants as R
from re import _parser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewatch.operators.case_queries import text_search
from casewatch.sources.files import read_table, stored, write_sorted

GRAM = 3
#: Characters of a class whose members are spelled out at most; strings that a run of literals and such classes may stand for.
SMALL_CLASS, MOST_RUNS = 8, 32
#: Candidates that are looked up by their ids; more are found by a join.
LOOKED_UP = 5000
#: Characters of a text whose grams are numbered at a time.
SLICE = 1 << 20
_FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)

#: A condition: a gram, ("and" or "or", conditions), or None, which nothing restricts.
Condition = str | tuple | None


def _all_of(parts: list[Condition]) -> Condition:
    parts = [p for p in parts if p is not None]
    return None if not parts else parts[0] if len(parts) == 1 else ("and", parts)


def _one_of(parts: list[Condition]) -> Condition:
    return None if any(p is None for p in parts) else parts[0] if len(parts) == 1 else ("or", parts)


def _characters(items) -> list[str] | None:
    """The characters of a small class, or None."""
    found: list[str] = []
    for kind, value in items:
        if kind is R.LITERAL:
            found.append(chr(value))
        elif kind is R.RANGE and value[1] - value[0] < SMALL_CLASS:
            found += map(chr, range(value[0], value[1] + 1))
        else:
            return None
    return found if len(found) <= SMALL_CLASS else None


def _spelled(run: str) -> Condition:
    folded = run.translate(_FOLD)
    return _all_of([folded[i : i + GRAM] for i in range(len(folded) - GRAM + 1)])


def _needed(items) -> Condition:
    parts, runs = [], [""]

    def flush() -> None:
        nonlocal runs
        parts.append(_one_of([_spelled(run) for run in runs]))
        runs = [""]

    for kind, value in items:
        if kind is R.AT:  # takes no characters
            continue
        following = [chr(value)] if kind is R.LITERAL else _characters(value) if kind is R.IN else None
        if following and len(runs) * len(following) <= MOST_RUNS:
            runs = [run + c for run in runs for c in following]
            continue
        flush()
        if kind is R.SUBPATTERN:
            parts.append(_needed(value[3]))
        elif kind is R.ATOMIC_GROUP:
            parts.append(_needed(value))
        elif kind is R.BRANCH:
            parts.append(_one_of([_needed(a) for a in value[1]]))
        elif kind in (R.MAX_REPEAT, R.MIN_REPEAT, R.POSSESSIVE_REPEAT) and value[0] > 0:
            parts.append(_needed(value[2]))
    flush()
    return _all_of(parts)


def needed_grams(pattern: str, literal: bool = False) -> Condition:
    """What the text of every match must hold, in lower case."""
    if literal:
        return _spelled(pattern)
    try:
        return _needed(_parser.parse(pattern))
    except (re.error, OverflowError, RecursionError):
        return None


def _grams_of(condition: Condition) -> set[str]:
    return {condition} if isinstance(condition, str) else set().union(*map(_grams_of, condition[1]))


def _holds(condition: Condition, grams: Column) -> Column:
    if isinstance(condition, str):
        return F.array_contains(grams, int(gram_numbers(condition.encode())[0]))
    out = None
    for part in condition[1]:
        held = _holds(part, grams)
        out = held if out is None else out & held if condition[0] == "and" else out | held
    return out


def _distinct(numbers: np.ndarray) -> np.ndarray:
    ordered = np.sort(numbers)  # faster than np.unique, which hashes
    return ordered[np.concatenate([np.ones(min(len(ordered), 1), bool), ordered[1:] != ordered[:-1]])]


def gram_numbers(text: bytes) -> np.ndarray:
    """The distinct grams of a text in UTF-8, A to Z in lower case, as numbers."""
    c = np.frombuffer(text.lower().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    found = []
    for at in range(0, len(c) - GRAM + 1, SLICE):
        part = c[at : at + SLICE + GRAM - 1].astype(np.int64)
        found.append(_distinct((part[:-2] << 42) | (part[1:-1] << 21) | part[2:]))
    return found[0] if len(found) == 1 else _distinct(np.concatenate([np.zeros(0, np.int64), *found]))


def build_index(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Write the index of ``docs`` below ``path``; a null text matches nothing and is left out. The key identifies a document."""
    kept = docs.filter(F.col(text).isNotNull())

    @F.pandas_udf("array<long>")
    def grams_of(texts: pd.Series) -> pd.Series:
        return pd.Series([gram_numbers(t) for t in texts], dtype=object)

    grams = kept.select(F.col(key).alias("id"), F.explode(grams_of(F.col(text).cast("string").cast("binary"))).alias("gram"))
    write_sorted(grams.select("gram", "id"), f"{path}/grams", ["gram"], ["id"])
    write_sorted(kept, f"{path}/texts", [key])


def candidates(spark: SparkSession, path: str, condition: Condition) -> DataFrame:
    """Ids of the documents whose grams satisfy a condition."""
    wanted = [int(gram_numbers(g.encode())[0]) for g in sorted(_grams_of(condition))]
    found = read_table(spark, f"{path}/grams").filter(F.col("gram").isin(wanted))
    return found.groupBy("id").agg(F.collect_set("gram").alias("grams")).filter(_holds(condition, F.col("grams"))).select("id")


def index_search(spark: SparkSession, path: str, pattern: str, key: str = "doc_id", text: str = "text", literal: bool = False) -> DataFrame:
    """The rows of ``text_search`` on the indexed documents."""
    texts = read_table(spark, f"{path}/texts")
    condition = needed_grams(pattern, literal)
    if condition is not None:
        few = stored(candidates(spark, path, condition), "candidates")
        if few.count() <= LOOKED_UP:
            texts = texts.filter(F.col(key).isin([r[0] for r in few.collect()]))
        else:
            texts = texts.join(few.withColumnRenamed("id", key), key, "left_semi")
    return text_search(texts, pattern, text, literal)
