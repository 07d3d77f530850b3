"""Operators on delimited token strings: support, profiles, rarity, pairs, tags, dictionaries."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.columns import as_col, percent, token_array
from lodestone.functions.text import clues, composed
from lodestone.operators.aggregate import group_profile
from lodestone.operators.basket import top_pairs


def explode_tokens(df: DataFrame, column: str, sep: str = ",", lower: bool = True,
                   distinct: bool = False, name: str = "token") -> DataFrame:
    """One row per token. Repeats inside a row are kept unless ``distinct``."""
    return df.withColumn(name, F.explode(token_array(column, sep, lower, distinct)))


def top_tokens(df: DataFrame, column: str, k: int = 20, sep: str = ",",
               digits: int = 2) -> DataFrame:
    """Commonest tokens with their share of all rows, rows without tokens included."""
    rows = df.agg(F.count(F.lit(1))).scalar()
    counts = (explode_tokens(df.select(column), column, sep)
              .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    return (counts.orderBy(F.desc("n"), F.asc("token")).limit(k)
            .withColumn("share_pct", percent(F.col("n"), rows, digits)))


def token_value_profile(df: DataFrame, column: str, value: str, min_rows: int = 10, k: int = 15,
                        sep: str = ",", unit: float = 1.0, digits: int = 2) -> DataFrame:
    """Count, average, median, min and max of ``value`` per token with enough rows, best
    average first."""
    valid = df.select(column, value).filter(F.col(column).isNotNull() & (F.col(value) > 0))
    profile = group_profile(explode_tokens(valid, column, sep), ["token"], value, unit, digits,
                            median=True, min_rows=min_rows)
    return profile.orderBy(F.desc("avg_value"), F.asc("token")).limit(k)


def token_rarity(df: DataFrame, doc: str, column: str, min_docs: int = 5, k: int | None = 50,
                 sep: str = ",", digits: int = 4) -> DataFrame:
    """Inverse document frequency ln(N/df) of tokens found in at least ``min_docs`` documents.

    Both N and df count distinct ``doc`` ids of rows whose token column is not null.
    """
    rows = df.filter(F.col(column).isNotNull()).select(doc, column)
    total = rows.agg(F.countDistinct(doc)).scalar()
    pairs = (explode_tokens(rows, column, sep, distinct=True).select(doc, "token")
             .distinct())
    freq = (pairs.groupBy("token").agg(F.count(F.lit(1)).alias("doc_freq"))
            .filter(F.col("doc_freq") >= min_docs))
    scored = freq.withColumn("idf", F.round(F.ln(total / F.col("doc_freq")), digits))
    if k is None:
        return scored
    return scored.orderBy(F.desc("idf"), F.asc("token")).limit(k)


def row_pairs(df: DataFrame, column: str, sep: str = ",", lower: bool = True) -> DataFrame:
    """Counts of unordered token pairs that share a row: columns ``a`` < ``b``, ``n``.

    Tokens of a row are de-duplicated first. Pairs are streamed out of the row one head token
    at a time and summed inside the task before the shuffle; no array of pairs is ever built.
    """
    items = token_array(column, sep, lower, distinct=True, ordered=True)
    heads = df.select(items.alias("_t")).select("_t", F.posexplode("_t").alias("_i", "a"))
    pairs = heads.select("a", F.explode(F.slice("_t", F.col("_i") + 2, F.size("_t"))).alias("b"))
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def pair_cooccurrence(df: DataFrame, column: str, k: int = 50, sep: str = ",",
                      lower: bool = True) -> DataFrame:
    """The ``k`` commonest token pairs as text "a + b"; see :func:`top_pairs` for what is counted."""
    rows = df.select(F.monotonically_increasing_id().alias("row"),
                     token_array(column, sep, lower, distinct=True).alias("_t"))
    rows = rows.select("row", F.explode("_t").alias("token"))
    return (top_pairs(rows, "row", "token", k)
            .select(F.concat_ws(" + ", "a", "b").alias("pair"), "n")
            .orderBy(F.desc("n"), F.asc("pair")).limit(k))


def tag_counts(df: DataFrame, column: str, patterns: Mapping[str, str], digits: int = 1,
               compose: bool = False) -> DataFrame:
    """How many rows match each named pattern, and the share of all rows: one pass over the
    text. Each row counts once per tag. Patterns are matched on lower-cased text with Unicode-aware
    classes; a pattern meets only the texts that hold one of its :func:`clues`. ``compose`` puts
    letters with combining marks in their composed form first (texts with marks pass through Python)."""
    def hit(pattern: str) -> Column:
        test = F.col("_text").rlike("(?U)" + pattern)
        words = clues(pattern)
        return reduce(lambda a, b: a | b, (F.col("_text").contains(w) for w in words)) & test if words \
            else test

    text = F.coalesce(F.col(column), F.lit(""))
    text = F.lower(composed(text) if compose else text).alias("_text")
    hits = [F.count_if(hit(p)).alias(f"t{i}") for i, p in enumerate(patterns.values())]
    wide = df.select(text).agg(F.count(F.lit(1)).alias("_rows"), *hits)
    tags = F.array(*[F.struct(F.lit(name).alias("tag"), F.col(f"t{i}").alias("n"))
                     for i, name in enumerate(patterns)])
    long = wide.select("_rows", F.explode(tags).alias("_t")).select("_t.*", "_rows")
    return (long.select("tag", "n", percent(F.col("n"), F.col("_rows"), digits).alias("pct"))
            .orderBy(F.desc("n"), F.asc("tag")))


def dictionary_terms(c: Column | str, terms: Sequence[str], capitalise: bool = False) -> Column:
    """Dictionary terms that occur in the text as whole words, in dictionary order.

    Word edges are look-arounds on word characters and + and #, so "c++" and "c#" are found
    and "java" is not found in "javascript". Terms that share no word cannot overlap, so they
    are searched together: a few scans of the text instead of one per term.
    """
    text = F.lower(F.coalesce(as_col(c), F.lit("")))
    found = F.flatten(F.array(*[
        F.regexp_extract_all(text, F.lit(_whole_word(group)), F.lit(1))
        for group in _separate(terms)
    ]))
    wanted = F.array(*[F.lit(t) for t in terms])
    out = F.array_intersect(wanted, found)
    return F.transform(out, _capitalised) if capitalise else out


def _capitalised(x: Column) -> Column:
    return F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, F.lit(2), F.length(x)))


def _separate(terms: Sequence[str]) -> list[list[str]]:
    """Split the terms into groups in which no two terms share a word."""
    groups: list[tuple[set[str], list[str]]] = []
    for term in terms:
        words = set(term.split())
        for used, members in groups:
            if not used & words:
                used |= words
                members.append(term)
                break
        else:
            groups.append((set(words), [term]))
    return [members for _, members in groups]


def _whole_word(terms: Sequence[str]) -> str:
    body = "|".join(re.escape(t) for t in sorted(terms, key=len, reverse=True))
    return r"(?U)(?<![\w+#])(" + body + r")(?![\w+#])"
