"""An index of names by trigrams, for the three name searches.

Names are folded (lower case, and the few letters beyond ASCII that a case-insensitive
search takes for an ASCII one), and every run of three characters of a folded name is
a posting. A search text says which trigrams a matching name must hold; the postings of
the rarest are intersected, and only the names left are looked at by the exact search.
A text without such trigrams looks at all names. Index and names are one table, written
and published together.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide import manifest
from pricetide.functions.text import matches_like, matches_literal, matches_regex
from pricetide.sinks.lake import show_parts
from pricetide.sources.tables import PARTITION

GRAM = 3
#: Trigrams that are intersected: the rarest of those a text requires.
USED = 4
#: What a case-insensitive search takes for s and i, after lower case; the dot is dropped.
_ALIKE, _ASCII = "ſı̇", "si"
_PLAIN = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 ,'-:;&!_/=<>@%~`\"")


def fold(name: Column) -> Column:
    return F.translate(F.lower(name), _ALIKE, _ASCII)


def write_names(names: DataFrame, root: str) -> int:
    """Replace the index at ``root`` by one of the distinct names; how many there are.

    Null names match no search and are left out.
    """
    spark, folder = names.sparkSession, manifest.new_folder()
    where = f"{root}/{folder}"
    distinct = names.select("name").where(F.col("name").isNotNull()).distinct()
    distinct.withColumn("name_id", F.monotonically_increasing_id()).write.parquet(f"{where}/names")
    numbered = spark.read.schema("name string, name_id long").parquet(f"{where}/names")
    folded = fold(F.col("name"))
    places = F.sequence(F.lit(1), F.length("folded") - (GRAM - 1))
    grams = F.array_distinct(F.transform(places, lambda i: F.substr(F.col("folded"), i, F.lit(GRAM))))
    posted = (
        numbered.withColumn("folded", folded)
        .where(F.length("folded") >= GRAM)
        .select(F.explode(grams).alias("gram"), "name_id")
    )
    # sorted by trigram: a search reads the row groups of its trigrams
    posted.repartitionByRange("gram", "name_id").sortWithinPartitions("gram", "name_id").write.parquet(f"{where}/postings")
    postings = spark.read.schema("gram string, name_id long").parquet(f"{where}/postings")
    counts = postings.groupBy("gram").agg(F.count("*").alias("n_names"))
    counts.repartitionByRange("gram").sortWithinPartitions("gram").write.parquet(f"{where}/grams")
    n_names = numbered.count()
    show_parts(spark, root, {manifest.WHOLE: folder}, {manifest.WHOLE}, numbered.schema, "parquet", PARTITION)
    return n_names


@dataclass(frozen=True)
class Found:
    """Names that match, the names that were looked at, and the trigrams that chose them."""

    names: DataFrame
    checked: DataFrame
    grams: tuple[str, ...]


def _grams(runs: list[str]) -> set[str]:
    return {r[i : i + GRAM] for r in runs for i in range(len(r) - GRAM + 1)}


def like_runs(text: str) -> list[str]:
    """The runs of literal characters in a LIKE text."""
    runs, run, at = [], "", 0
    while at < len(text):
        if text[at] == "\\" and at + 1 < len(text):
            run, at = run + text[at + 1], at + 2
            continue
        if text[at] in "%_":
            runs, run = [*runs, run], ""
        else:
            run += text[at]
        at += 1
    return [*runs, run]


def regex_runs(pattern: str) -> list[str]:
    """Runs of characters that every match of a regular expression holds.

    Only what is certain without reading groups, classes and escapes; alternatives at the top
    and special groups give none.
    """
    if "(?" in pattern or "\\" in pattern:
        return []
    runs, run, depth, at = [], "", 0, 0
    while at < len(pattern):
        c = pattern[at]
        if c == "[":
            # the first character of a class may be a bracket that closes nothing
            end = pattern.find("]", at + (3 if pattern[at + 1 : at + 2] == "^" else 2))
            if end < 0 or "[" in pattern[at + 1 : end]:
                return []
            runs, run, at = [*runs, run], "", end
        elif c in "()":
            depth += 1 if c == "(" else -1
            runs, run = [*runs, run], ""
        elif depth:
            pass
        elif c == "|":
            return []
        elif c in "?*{":
            runs, run = [*runs, run[:-1]], ""
            if c == "{":
                at = max(at, pattern.find("}", at))
        elif c in _PLAIN:
            run += c
        else:  # + . ^ $ and letters with a case of their own
            runs, run = [*runs, run], ""
        at += 1
    return [*runs, run] if depth == 0 else []


def _search(spark: SparkSession, root: str, runs: list[str], matches: Callable[[Column], Column]) -> Found:
    found = manifest.current(spark, root)
    where = f"{root}/{found.parts[manifest.WHOLE]}"
    names = spark.read.schema(found.struct()).parquet(f"{where}/names")
    required = sorted(_grams([r.translate(str.maketrans({"ſ": "s", "ı": "i", "̇": ""})) for r in runs]))
    if not required:
        return Found(names.where(matches(F.col("name"))).select("name"), names, ())
    counted = spark.read.schema("gram string, n_names long").parquet(f"{where}/grams")
    known = counted.where(F.col("gram").isin(*required)).orderBy("n_names", "gram").collect()
    if len(known) < len(required):  # a trigram that no name holds
        return Found(names.limit(0).select("name"), names.limit(0), tuple(required))
    used = [r.gram for r in known[:USED]]
    postings = spark.read.schema("gram string, name_id long").parquet(f"{where}/postings")
    held = postings.where(F.col("gram").isin(*used))
    if len(used) > 1:
        held = held.groupBy("name_id").agg(F.count("*").alias("n")).where(F.col("n") == len(used))
    checked = names.join(held.select("name_id"), "name_id", "left_semi")
    return Found(checked.where(matches(F.col("name"))).select("name"), checked, tuple(used))


def _lower(spark: SparkSession, text: str) -> str:
    return spark.sql("SELECT lower(:text)", args={"text": text}).first()[0]


def search_like(spark: SparkSession, root: str, text: str) -> Found:
    """Names that contain ``text``, with LIKE wildcards live."""
    runs = like_runs(_lower(spark, text))
    return _search(spark, root, runs, lambda name: matches_like(name, text))


def search_literal(spark: SparkSession, root: str, text: str) -> Found:
    """Names that contain ``text`` as it stands."""
    return _search(spark, root, [_lower(spark, text)], lambda name: matches_literal(name, text))


def search_regex(spark: SparkSession, root: str, pattern: str) -> Found:
    """Names that match ``pattern``."""
    runs = [r.lower() for r in regex_runs(pattern)]
    return _search(spark, root, runs, lambda name: matches_regex(name, pattern))


def with_names(df: DataFrame, names: DataFrame) -> DataFrame:
    """Rows of ``df`` that have one of ``names``."""
    return df.join(names, "name", "left_semi")
