"""Encoders fitted on the training split and applied to every split
(E01-E13).  Fitting is one aggregate over ``split = 'train'``; the fitted
state is a small table (or a literal map when its size is bounded by the
routing rule), so train, validation and test always get the same columns."""

from __future__ import annotations

import re
import uuid
from itertools import chain

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from lathe.functions.text import safe_names, strip_blanks
from lathe.operators.joins import map_encode_join
from lathe.operators.ordering import global_row_number
from lathe.operators.quantiles import wide_quantiles
from lathe.operators.windows import frequency_rank
from lathe.session import checkpoint_dir, stage_table


def _map_literal(mapping: dict) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))


def ordinal_encode(df: DataFrame, orders: dict[str, list[str]], strict: bool = False,
                   unknown: int = -1, suffix: str = "_ordinal", trim: bool = True,
                   normalise=None) -> DataFrame:
    """Position in a fixed ordered list (0-based).  NULL stays NULL; an
    unknown label raises when ``strict`` else gives ``unknown``."""
    new = []
    for col, order in orders.items():
        key = strip_blanks(F.col(col)) if trim else F.col(col)
        if normalise and col in normalise:
            key = normalise[col](key)
        code = F.try_element_at(_map_literal({v: i for i, v in enumerate(order)}), key)
        miss = (F.raise_error(F.concat(F.lit(f"unknown label in {col}: "), key)).cast("int")
                if strict else F.lit(unknown))
        new.append(F.when(F.col(col).isNull(), F.lit(None).cast("int"))
                   .otherwise(F.coalesce(code, miss)).cast("int").alias(f"{col}{suffix}"))
    return df.select("*", *new)


def mapped_ordinal(df: DataFrame, col: str, mapping: dict, unseen: int = -1,
                   out: str | None = None) -> DataFrame:
    code = F.try_element_at(_map_literal(mapping), F.col(col))
    return df.withColumn(out or f"{col}_ordinal",
                         F.when(F.col(col).isNull(), F.lit(None).cast("int"))
                         .otherwise(F.coalesce(code, F.lit(unseen))).cast("int"))


def fit_frequency_ordinal(train: DataFrame, col: str) -> DataFrame:
    """Dictionary ``(key, value)``: code by descending train frequency, ties
    by value (most frequent = 0)."""
    r = frequency_rank(train, col)
    return r.select(F.col(col).alias("key"), F.col("code").alias("value"))


def frequency_ordinal(train: DataFrame, df: DataFrame, cols: list[str], unseen: int = -1) -> DataFrame:
    """Columns routed to 2..10 distinct values: lookup in the dictionary."""
    for c in cols:
        d = fit_frequency_ordinal(train, c)
        df = map_encode_join(df, c, d, f"{c}_ordinal", default=unseen)
        df = df.withColumn(f"{c}_ordinal", F.col(f"{c}_ordinal").cast("int"))
    return df


def fit_vocabulary(train: DataFrame, col: str) -> list:
    """Sorted distinct values of a column: the names of the columns to come."""
    return sorted(r[0] for r in train.select(col).where(F.col(col).isNotNull()).distinct().collect())


def one_hot_all(train: DataFrame, df: DataFrame, col: str, prefix: str | None = None) -> DataFrame:
    """One indicator per value seen in train (same columns on every split)."""
    vocab = fit_vocabulary(train, col)
    p = prefix or col
    return df.select("*", *[(F.col(col) == F.lit(v)).cast("int").alias(f"{p}_{name}")
                            for v, name in zip(vocab, safe_names(vocab))])


def multi_hot_tokens(df: DataFrame, col: str, options: list[str], prefix: str,
                     sep: str = ",") -> DataFrame:
    """Split a multi-choice text on ``sep``, trim tokens and flag each preset
    option (missing -> 0).  The same result as explode -> pivot(explicit
    values) -> fill 0 -> join back, but as one projection with no shuffle."""
    toks = F.transform(F.split(F.coalesce(F.col(col), F.lit("")), re.escape(sep), -1),
                       strip_blanks)
    return df.select("*", *[F.array_contains(toks, F.lit(o)).cast("int")
                            .alias(f"{prefix}_{name}") for o, name in zip(options, safe_names(options))])


def multi_select_flags(train: DataFrame, df: DataFrame, col: str, sep: str = ",",
                       prefix: str = "verified", count_col: str = "verification_count") -> DataFrame:
    """Token vocabulary from train; a literal-substring flag per token and
    the token count."""
    toks = (train.select(F.explode(F.split(F.col(col), re.escape(sep), -1)).alias("t"))
            .select(strip_blanks(F.col("t")).alias("t")).where(F.col("t") != "").distinct().orderBy("t"))
    vocab = [r[0] for r in toks.collect()]
    flags = [F.col(col).contains(v).cast("int").alias(f"{prefix}_{name}")
             for v, name in zip(vocab, safe_names(vocab))]
    return df.select("*", *flags, F.size(F.split(F.col(col), re.escape(sep), -1)).alias(count_col))


def fit_token_index(train: DataFrame, tokens: Column) -> DataFrame:
    """(name, index): the distinct tokens of an array column, numbered from 0
    in their order without passing through the driver or one task."""
    names = train.select(F.explode(tokens).alias("name")).where("name is not null").distinct()
    return stage_table(global_row_number(names, ["name"], col="_n").select("name", (F.col("_n") - 1).cast("int").alias("index")),
                       "token-index")


def sparse_indicators(df: DataFrame, id_col: str, tokens: Column, index: DataFrame, out: str = "features") -> DataFrame:
    """(id, ``out``): a 0/1 indicator for each token of ``index`` as the parts of
    a sparse vector (size, sorted indices, values).  Tokens without an index are
    left out; a row without any (or with NULL) has an empty one.  ``id_col``
    identifies the row.  Any number of tokens, as no column is made for one."""
    size = index.count()
    met = (df.select(F.col(id_col).alias("_id"), F.explode(F.array_distinct(tokens)).alias("name"))
           .join(index, "name").groupBy("_id").agg(F.array_sort(F.collect_list("index")).alias("_at")))
    held = df.select(F.col(id_col)).join(met, F.col(id_col).eqNullSafe(F.col("_id")), "left")
    at = F.coalesce("_at", F.array().cast("array<int>"))
    return held.select(id_col, F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), at.alias("indices"),
        F.transform(at, lambda _: F.lit(1.0)).alias("values")).alias(out))


def as_vectors(df: DataFrame, col: str = "features") -> DataFrame:
    """Sparse parts (``sparse_indicators``) as a Spark ML vector column: written
    once and read again as vectors, whose stored form is just these parts."""
    schema = StructType([StructField(f.name, VectorUDT(), True) if f.name == col else f for f in df.schema])
    path = f"{checkpoint_dir(df.sparkSession)}/lathe-stage/vectors-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def fit_top_k(train: DataFrame, col: str, k: int = 10) -> list:
    top = (train.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), F.asc_nulls_first(col)).limit(k).collect())
    return [r[0] for r in top]


def top_k_one_hot(train: DataFrame, df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """Indicators for the k most frequent train values plus ``_other``."""
    top = fit_top_k(train, col, k)
    known = [v for v in top if v is not None]
    flags = [(F.col(col) == F.lit(v)).cast("int").alias(f"{col}_{name}")
             for v, name in zip(known, safe_names(known, 50))]
    other = (~F.col(col).isin([v for v in top if v is not None])).cast("int").alias(f"{col}_other")
    return df.select("*", *flags, other)


def fit_frequency(train: DataFrame, col: str, normalize: bool = False) -> DataFrame:
    g = train.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    if normalize:
        total = train.count()
        return g.select(F.col(col).alias("key"), (F.col("n") / F.lit(total)).alias("value"))
    return g.select(F.col(col).alias("key"), F.col("n").cast("double").alias("value"))


def frequency_encode(train: DataFrame, df: DataFrame, col: str, normalize: bool = False,
                     default: float = 0.0, out: str | None = None) -> DataFrame:
    """Train count (or share) per value, unseen -> ``default``.  The
    dictionary grows with the vocabulary, so it is not force-broadcast."""
    d = fit_frequency(train, col, normalize)
    return map_encode_join(df, col, d, out or f"{col}_freq", default=default) \
        .withColumn(out or f"{col}_freq", F.col(out or f"{col}_freq").cast("double"))


def route_by_cardinality(train: DataFrame, cols: list[str], bands=(2, 10, 30)) -> DataFrame:
    """Which encoder each string column gets, from ONE distinct-count pass:
    ``lo..mid`` -> frequency_ordinal, ``mid+1..hi`` -> top_k_one_hot,
    ``> hi`` -> frequency_encode, below ``lo`` -> drop."""
    lo, mid, hi = bands
    one = train.agg(*[(F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(f"nu__{i}")
                      for i, c in enumerate(cols)])  # NULL is a value
    long = one.selectExpr(f"stack({len(cols)}, " + ", ".join(
        f"'{c}', `nu__{i}`" for i, c in enumerate(cols)) + ") as (column, n_unique)")
    route = (F.when(F.col("n_unique") < lo, "drop")
             .when(F.col("n_unique") <= mid, "frequency_ordinal")
             .when(F.col("n_unique") <= hi, "top_k_one_hot")
             .otherwise("frequency_encode"))
    return long.select("column", F.col("n_unique").cast("long").alias("n_unique"), route.alias("route"))


def fit_medians(train: DataFrame, cols: list[str]) -> dict:
    """Exact median per column (NULLs ignored), all columns at once."""
    med = wide_quantiles(train, cols, [0.5], ["median"])
    return {r["column"]: r["median"] for r in med.collect()}


def median_impute(train: DataFrame, df: DataFrame, cols: list[str]) -> DataFrame:
    """Fill NULLs with the train median (pass ``train=df`` for the
    reference's fit-on-all behaviour)."""
    meds = fit_medians(train, cols)
    return df.select(*[F.coalesce(F.col(c), F.lit(meds.get(c))).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def missing_flags(df: DataFrame, cols: list[str], names: dict | None = None) -> DataFrame:
    names = names or {}
    return df.select("*", *[F.col(c).isNotNull().cast("int").alias(names.get(c, f"has_{c}"))
                            for c in cols])
