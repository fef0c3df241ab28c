"""Operator 6: quality rules as a learned decision list.

Statistics of every whole text come from an Arrow UDF; a bounded, seeded sample
of labelled rows goes to the driver, where sequential covering learns rejecting
rules: each rule is grown as a conjunction of thresholds by information gain on
two thirds of the sample, pruned on the rest, kept if it is precise enough
there, and the rows that it covers are removed.  The list becomes an ordered
Spark ``when`` expression, so judging needs no Python.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.llm.common import BLANKS, gram_hashes, stage_table, table, word_hashes

SYMBOLS = b"#*$%&|<>"      # fixed values: characters, windows and limits of the base rules
REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SAMPLE_ROWS = 20_000       # labelled rows that the rules are fitted on, at most
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_digits",
         "n_upper", "n_stops", "n_distinct_words")
_SCHEMA = ", ".join(f"{s} long" for s in STATS)


def _byte_set(values: bytes) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[list(values)] = True
    return mask


_IS_SYMBOL, _IS_DIGIT = _byte_set(SYMBOLS), _byte_set(b"0123456789")
_IS_UPPER, _IS_STOP = _byte_set(bytes(range(65, 91))), _byte_set(b".!?")
_IS_BLANK = _byte_set(BLANKS)
_STARTS_CHAR = (np.arange(256) & 0xC0) != 0x80


def text_stats(text: bytes) -> tuple[int, ...]:
    """The statistics of one text, in the order of ``STATS``."""
    buf = np.frombuffer(text, np.uint8)
    start, _, words = word_hashes(buf)
    grams = gram_hashes(words, REPEAT_WINDOW)
    repeated = 0
    if len(grams) > 1:
        order = np.argsort(grams, kind="stable")
        equal = grams[order][1:] == grams[order][:-1]
        if equal.any():
            again = np.zeros(len(grams), bool)
            again[order[1:][equal]] = True
            again[order[:-1][equal]] = True
            edge = np.zeros(len(words) + 1, np.int64)
            at = np.flatnonzero(again)
            edge[at] += 1
            np.add.at(edge, at + REPEAT_WINDOW, -1)
            repeated = int((np.cumsum(edge[:-1]) > 0).sum())
    lines = [x for x in text.split(b"\n") if x.strip(BLANKS)]
    count = np.bincount(buf, minlength=256)
    return (len(words), int(count[_STARTS_CHAR & ~_IS_BLANK].sum()), int(count[_IS_SYMBOL].sum()),
            len(lines) - len(set(lines)), repeated, len(lines), int(count[_IS_DIGIT].sum()),
            int(count[_IS_UPPER].sum()), int(count[_IS_STOP].sum()), len(np.unique(words)))


def _stats_of(texts: pd.Series) -> pd.DataFrame:
    rows = [text_stats((t or "").encode()) for t in texts]
    return pd.DataFrame(rows, columns=list(STATS))


def _features() -> dict[str, Column]:
    words = F.greatest(F.col("s.n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("s.word_chars"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("s.n_lines"), F.lit(1)).cast("double")
    return {"words": F.col("s.n_words").cast("double"), "word_length": F.col("s.word_chars") / words,
            "symbol_share": F.col("s.n_symbols") / chars, "dup_line_share": F.col("s.n_dup_lines") / lines,
            "repeat_share": F.col("s.n_repeat_words") / words, "digit_share": F.col("s.n_digits") / chars,
            "upper_share": F.col("s.n_upper") / chars, "stops_per_word": F.col("s.n_stops") / words,
            "distinct_share": F.col("s.n_distinct_words") / words, "words_per_line": F.col("s.n_words") / lines}


def with_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` in a struct column ``row`` beside the statistics struct ``s``."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.pandas_udf(_stats_of, _SCHEMA)(F.col(f"`{text_col}`")).alias("s"))


def base_failed() -> Column:
    return ((F.col("s.n_words") < MIN_WORDS)
            | (100 * F.col("s.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("s.n_words")))


class DecisionList:
    """Ordered rejecting rules: each a list of (feature, op, threshold)."""

    def __init__(self, rules: list[list[tuple[str, str, float]]]):
        self.rules = rules

    def rejects(self, features: dict[str, Column]) -> Column:
        """True where a rule fires, in the list's order; false otherwise."""
        chain = None
        for rule in self.rules:
            fires = None
            for name, op, limit in rule:
                one = features[name] <= F.lit(limit) if op == "<=" else features[name] > F.lit(limit)
                fires = one if fires is None else fires & one
            chain = F.when(fires, F.lit(True)) if chain is None else chain.when(fires, F.lit(True))
        return F.lit(False) if chain is None else chain.otherwise(F.lit(False))


def _covered(x: np.ndarray, rule) -> np.ndarray:
    mask = np.ones(len(x), bool)
    for j, op, limit in rule:
        mask &= (x[:, j] <= limit) if op == "<=" else (x[:, j] > limit)
    return mask


def _grow(x, y, cuts, max_terms):
    rule, mask = [], np.ones(len(x), bool)
    while len(rule) < max_terms:
        p0, n0 = (mask & y).sum(), mask.sum()
        if p0 == n0:
            break
        best, found = 0.0, None
        for j, limits in enumerate(cuts):
            column, label = x[mask, j], y[mask]
            order = np.argsort(column, kind="stable")
            at = np.searchsorted(column[order], limits, side="right")
            hits = np.concatenate([[0], np.cumsum(label[order])])
            for op, p, n in (("<=", hits[at], at), (">", hits[-1] - hits[at], n0 - at)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / np.maximum(n, 1)) - np.log2(p0 / n0)), 0.0)
                k = int(np.argmax(gain)) if len(gain) else -1
                if k >= 0 and gain[k] > best + 1e-9:
                    best, found = float(gain[k]), (j, op, float(limits[k]))
        if found is None:
            break
        rule.append(found)
        mask = _covered(x, rule)
    return rule


def learn_rules(x: np.ndarray, bad: np.ndarray, names: list[str], min_precision: float = 0.95,
                min_covered: int = 8, max_terms: int = 4, max_rules: int = 32, seed: int = 3) -> DecisionList:
    """Sequential covering on a labelled sample; ``bad`` marks rows to reject.
    Without rows, or with one class only, the list is empty."""
    rules: list = []
    held = np.random.Generator(np.random.PCG64(seed)).random(len(x)) < 1 / 3
    left = np.ones(len(x), bool)
    while len(rules) < max_rules:
        grow, prune = left & ~held, left & held
        if bad[grow].sum() < min_covered or bad[grow].all():
            break
        cuts = [np.unique(np.quantile(x[grow, j], np.linspace(0, 1, 65))) for j in range(x.shape[1])]
        rule = _grow(x[grow], bad[grow], cuts, max_terms)
        xp, yp = x[prune], bad[prune]

        def worth(r):
            mask = _covered(xp, r)
            good = int((mask & yp).sum())
            return (2 * good - int(mask.sum())) / max(1, int(mask.sum())), good
        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        mask = _covered(xp, rule) if rule else np.zeros(len(xp), bool)
        hit, all_ = int((mask & yp).sum()), int(mask.sum())
        if not rule or hit < max(1, min_covered // 3) or hit < min_precision * all_:
            break
        rules.append(rule)
        left &= ~_covered(x, rule)
    return DecisionList([[(names[j], op, limit) for j, op, limit in r] for r in rules])


def fit_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              sample_rows: int = SAMPLE_ROWS, seed: int = 5, **limits) -> DecisionList:
    """Learn from the ``sample_rows`` labelled ids that come first in a seeded
    hash order, and of at most ``2 * sample_rows`` rows that have these ids (the
    first by id and statistics, where ids repeat).  Contradictory labels of
    one id count as bad; null labels and null ids are left out."""
    known = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
             .agg(F.min("quality").alias("quality")))
    sample = (known.orderBy(F.xxhash64(F.lit(seed), F.col("doc_id")), "doc_id").limit(sample_rows)
              .select(F.col("doc_id").alias("l_id"), "quality"))
    chosen = docs.select(F.col(f"`{id_col}`").alias("l_id"), F.col(f"`{text_col}`").alias("text"))
    # the sample's size is bounded by sample_rows; its texts are staged, so that statistics are made of them alone
    rows = with_stats(stage_table(chosen.join(F.broadcast(sample), "l_id").select("l_id", "text", "quality"), "rules-sample"))
    features = _features()
    rows = rows.where(~base_failed()).select("row.l_id", "row.quality", *[c.alias(n) for n, c in features.items()])
    got = rows.orderBy("l_id", *features).limit(2 * sample_rows).toPandas()
    return learn_rules(got[list(features)].to_numpy(np.float64), (got["quality"] == 0).to_numpy(),
                       list(features), **limits)


def judged(docs: DataFrame, rules: DecisionList, text_col: str = "text") -> DataFrame:
    """``row``, ``s``, ``base_failed`` and ``kept`` for every row of ``docs``."""
    return (with_stats(docs, text_col).withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & ~rules.rejects(_features())))


def quality_report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   **fit) -> DataFrame:
    """One row per document: id, the statistics, base_failed, kept.

    A null text has no words (and fails the base rules); null ids and repeated
    rows are judged like any other; texts of any length are read whole; an
    empty table gives no rows; without usable labels the list is empty and only
    the base rules reject; other columns are ignored.
    """
    rules = fit_rules(docs, labels, id_col, text_col, **fit)
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return judged(narrow, rules).select(
        F.col("row.id").alias(id_col), *[F.col(f"s.{s}") for s in STATS], "base_failed", "kept")


def kept_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   **fit) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    rules = fit_rules(docs, labels, id_col, text_col, **fit)
    return judged(docs, rules, text_col).where("kept").select("row.*")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", *STATS[:5], "base_failed", "kept")
