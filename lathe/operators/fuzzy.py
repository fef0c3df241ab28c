"""Fuzzy entity filters.

Ratcliff-Obershelp similarity is twice the letters in common blocks over the
letters of both words.  It is filtered and verified word by word: Spark splits
the texts into distinct words, a native bound (letters that both words have,
however they are placed) discards most of them, and only the distinct words that
are left are compared block by block in Python.  Whole texts never go there;
the words' similarities are joined back to the words, pairs and texts they came
from.  ``edit_similarity`` is the native Levenshtein screen for the same question."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

_BLANKS = r"(?U)[\s\x1c-\x1f]+"


def common_letters(a: str, b: str) -> int:
    """Letters in common blocks: those of the longest block (the first one in
    ``a``, then in ``b``), and of the parts before and after it likewise."""
    total, todo = 0, [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        size, ai, bi = 0, alo, blo
        ends: dict[int, int] = {}  # length of the block that ends at a place of b
        for i in range(alo, ahi):
            row: dict[int, int] = {}
            for j in range(blo, bhi):
                if a[i] == b[j]:
                    n = row[j] = ends.get(j - 1, 0) + 1
                    if n > size:
                        size, ai, bi = n, i - n + 1, j - n + 1
            ends = row
        if size:
            total += size
            todo += [(alo, ai, blo, bi), (ai + size, ahi, bi + size, bhi)]
    return total


def ratio(a: str, b: str) -> float:
    return 2.0 * common_letters(a, b) / (len(a) + len(b)) if a or b else 1.0


def ratio_bound(word: Column, target: str) -> Column:
    """At least the ratio of a word to ``target``: as if all letters that both
    have stood in common blocks."""
    shared = F.lit(0)
    for letter, n in sorted(Counter(target).items()):
        shared = shared + F.least(F.length(word) - F.length(F.replace(word, F.lit(letter), F.lit(""))), F.lit(n))
    return shared * 2.0 / (F.length(word) + F.lit(len(target)))


def _ratios(words: DataFrame, target: str) -> DataFrame:
    """(w, ratio) of the distinct words of a one-column table."""
    @F.pandas_udf("double")
    def verify(s: pd.Series) -> pd.Series:
        return s.map(lambda w: ratio(w, target))
    return words.select(F.col(words.columns[0]).alias("w")).distinct().select("w", verify("w").alias("ratio"))


def _texts(df: DataFrame, col: str, words: Column) -> DataFrame:
    """(_v, _words) of the distinct texts."""
    return df.select(F.col(col).alias("_v")).where("_v is not null").distinct().select(
        "_v", F.filter(words, lambda w: w != "").alias("_words"))


def _flag(df: DataFrame, col: str, hits: DataFrame, out: str) -> DataFrame:
    marked = hits.select("_v", F.lit(True).alias("_hit")).distinct()
    return (df.join(marked, df[col] == marked["_v"], "left")
            .withColumn(out, F.coalesce("_hit", F.lit(False))).drop("_v", "_hit"))


def fuzzy_word_match(df: DataFrame, col: str, target: str, threshold: float = 0.6,
                     out: str = "is_match") -> DataFrame:
    """``out``: some word of the lower-cased text has a ratio of at least the
    threshold; false for NULL."""
    texts = _texts(df, col, F.split(F.lower("_v"), _BLANKS))
    words = texts.select("_v", F.explode(F.array_distinct("_words")).alias("w"))
    near = words.where(ratio_bound(F.col("w"), target) >= threshold)
    good = _ratios(near.select("w"), target).where(F.col("ratio") >= threshold)
    return _flag(df, col, near.join(good, "w", "left_semi"), out)


def fuzzy_bigram_match(df: DataFrame, col: str, pair: tuple[str, str], threshold: float = 0.6,
                       out: str = "is_match", min_words: int = 2, max_words: int = 6) -> DataFrame:
    """``out``: the text has 2 to 6 words, and the mean of the ratios of two
    neighbouring words to the pair is strictly above the threshold; false
    for NULL.  Case counts."""
    first, second = pair
    few = _texts(df, col, F.split("_v", _BLANKS)).where(F.size("_words").between(min_words, max_words))
    steps = F.sequence(F.lit(0), F.size("_words") - 2)
    pairs = few.select("_v", F.explode(F.transform(
        steps, lambda i: F.struct(F.get("_words", i).alias("a"), F.get("_words", i + 1).alias("b")))).alias("p")) \
        .select("_v", "p.a", "p.b")
    bound = (ratio_bound(F.col("a"), first) + ratio_bound(F.col("b"), second)) / 2
    near = pairs.where(bound > threshold - 1e-12)
    left = _ratios(near.select("a"), first).select(F.col("w").alias("a"), F.col("ratio").alias("ra"))
    right = _ratios(near.select("b"), second).select(F.col("w").alias("b"), F.col("ratio").alias("rb"))
    hits = near.join(left, "a").join(right, "b").where((F.col("ra") + F.col("rb")) / 2 > threshold)
    return _flag(df, col, hits, out)


def edit_similarity(c, target: str, threshold: float) -> Column:
    """Native screen: some word has ``1 - levenshtein/max(len) >= threshold``."""
    col = F.col(c) if isinstance(c, str) else c
    words = F.split(F.lower(col), r"\s+")
    t = F.lit(target)
    return F.exists(words, lambda w: (F.lit(1.0) - F.levenshtein(w, t) /
                                      F.greatest(F.length(w), F.length(t))) >= F.lit(threshold))


def fuzzy_recovery_report(df: DataFrame, col: str, exact: Column, fuzzy_col: str) -> DataFrame:
    """Rows and distinct values per match kind: exact / fuzzy only / none."""
    kind = (F.when(F.coalesce(exact, F.lit(False)), "exact")
            .when(F.col(fuzzy_col), "fuzzy").otherwise("none"))
    return df.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("rows"),
                                              F.count_distinct(col).alias("values"))
