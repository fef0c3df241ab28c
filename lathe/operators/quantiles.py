"""Exact quantiles of many columns at once.

1. One aggregate builds a KLL sketch for every column (and group).  Its quantiles
   a little below and above a target rank bracket the wanted value.
2. One aggregate counts, for every bracket, the rows below it and the rows
   inside.  A bracket that missed its rank is opened on that side; one that holds
   more than ``MOST`` rows, and more than one value, is cut again by a
   sketch of its own rows.
3. Only the rows of the brackets are left: their values are counted and the
   target ranks are read off.  A bracket of one value needs no rows at all.

Rows are never unpivoted and carry no cut points but the brackets of their group.
The work is a few passes over the narrow columns; each further pass of step 2 cuts
the brackets by a factor of about a hundred."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from lathe.session import stage_table

SKETCH = 4_000           # the KLL parameter k
SLACK = 0.003            # share of the rows by which a bracket exceeds its rank, twice k's usual error
GRID = 400               # steps of the ranks at which a bracket is cut again
MOST = 200_000           # rows of a bracket that one window may order


def _on(groups: list[str]):
    return reduce(lambda a, b: a & b, [F.col(f"g{i}").eqNullSafe(F.col(f"h{i}")) for i in range(len(groups))])


def _with_brackets(base: DataFrame, brackets: DataFrame, groups: list[str], names: list[str]) -> DataFrame:
    """Rows with the brackets of their group; without groups these are literals."""
    if not groups:
        row = brackets.select(*names).first()
        return base.select("*", *[F.lit(row[n]).cast("double").alias(n) for n in names])
    side = brackets.select(*[F.col(f"g{i}").alias(f"h{i}") for i in range(len(groups))], *names)
    return base.join(side, _on(groups)).drop(*[f"h{i}" for i in range(len(groups))])


def _pinned(df: DataFrame, groups: list[str], name: str) -> DataFrame:
    """A table of one row a group, computed now: staged, or held as it is where
    there is one row in all."""
    if groups:
        return stage_table(df, name)
    return df.sparkSession.createDataFrame([tuple(df.first())], df.schema)


def wide_quantiles(df: DataFrame, cols: list[str], qs: list[float], names: list[str],
                   group_cols: list[str] | None = None, method: str = "linear", stage: bool = True) -> DataFrame:
    """(group..., column, a column for each quantile): exact quantiles of every
    column, NULLs ignored.  ``linear`` interpolates between the two nearest ranks,
    ``nearest`` takes the rank next to ``(n - 1) q`` (halves up).  NaN counts
    as the largest value and is returned as infinity.  A column without values
    has NULL quantiles.  The narrow columns are staged unless ``stage`` is off
    (for a plain table scan, which is as cheap to read again)."""
    groups, gs = list(group_cols or []), [f"g{i}" for i in range(len(group_cols or []))]
    vs = [f"v{i}" for i in range(len(cols))]
    number = [F.when(F.isnan(F.col(c).cast("double")), F.lit(float("inf"))).otherwise(F.col(c).cast("double")) for c in cols]
    base = df.select(*[F.col(g).alias(a) for g, a in zip(groups, gs)], *[x.alias(v) for x, v in zip(number, vs)])
    if stage:
        base = stage_table(base, "quantile-input")
    targets = [(i, j) for i in range(len(cols)) for j in range(len(qs))]

    def t(kind: str, i: int, j: int) -> str:
        return f"{kind}_{i}_{j}"

    def ranks(i: int, j: int):
        pos = F.greatest(F.col(f"n_{i}") - 1, F.lit(0)).cast("double") * F.lit(float(qs[j]))
        if method == "nearest":
            a = F.floor(pos + F.lit(0.5)) + 1
            return a, a, F.lit(0.0)
        return F.floor(pos) + 1, F.ceil(pos) + 1, pos - F.floor(pos)

    # 1. sketches and first brackets
    sketched = _pinned(base.groupBy(*gs).agg(*[x for i, v in enumerate(vs) for x in (
        F.count(v).alias(f"n_{i}"), F.min(v).alias(f"min_{i}"), F.max(v).alias(f"max_{i}"),
        F.kll_sketch_agg_double(v, F.lit(SKETCH)).alias(f"s_{i}"))]), groups, "quantile-sketches")
    first = []
    for i, j in targets:
        a, b, fr = ranks(i, j)
        few, sketch = F.col(f"n_{i}") <= SKETCH, F.col(f"s_{i}")  # few rows are one bracket
        lo = F.when(few, F.col(f"min_{i}")).otherwise(F.kll_sketch_get_quantile_double(sketch, F.lit(max(0.0, qs[j] - SLACK))))
        hi = F.when(few, F.col(f"max_{i}")).otherwise(F.kll_sketch_get_quantile_double(sketch, F.lit(min(1.0, qs[j] + SLACK))))
        first += [a.cast("long").alias(t("a", i, j)), b.cast("long").alias(t("b", i, j)), fr.alias(t("f", i, j)),
                  F.when(F.col(f"n_{i}") > 0, lo).alias(t("lo", i, j)), F.when(F.col(f"n_{i}") > 0, hi).alias(t("hi", i, j))]
    brackets = sketched.select(*gs, *[f"{k}_{i}" for i in range(len(cols)) for k in ("n", "min", "max")], *first)
    names_lo_hi = [t(k, i, j) for i, j in targets for k in ("lo", "hi")]

    # 2. count, open, cut again
    margin = math.ceil(SLACK * GRID)
    grid = F.array(*[F.lit(k / GRID) for k in range(GRID + 1)])

    def at_rank(sketch, step):
        step = F.least(F.greatest(step, F.lit(0)), F.lit(GRID))
        return F.element_at(F.kll_sketch_get_quantile_double(sketch, grid), (step + 1).cast("int"))
    while True:
        held = _with_brackets(base, brackets, groups, names_lo_hi)
        counts, again = [], []
        for i, j in targets:
            v, lo, hi = F.col(vs[i]), F.col(t("lo", i, j)), F.col(t("hi", i, j))
            inside = (v >= lo) & (v <= hi)
            counts += [F.count_if(v < lo).alias(t("below", i, j)), F.count_if(inside).alias(t("in", i, j))]
        counted = held.groupBy(*gs).agg(*counts)
        state = _pinned(_beside(brackets, counted, groups), groups, "quantile-brackets")
        missed = [F.coalesce((F.col(f"n_{i}") > 0) & ((F.col(t("below", i, j)) >= F.col(t("a", i, j)))
                             | (F.col(t("below", i, j)) + F.col(t("in", i, j)) < F.col(t("b", i, j)))), F.lit(False))
                  for i, j in targets]
        large = [F.coalesce((F.col(t("in", i, j)) > MOST) & (F.col(t("lo", i, j)) < F.col(t("hi", i, j))), F.lit(False))
                 for i, j in targets]
        any_of = lambda marks: reduce(lambda x, y: x | y, marks)
        todo = state.agg(F.max(any_of(missed).cast("int")).alias("m"), F.max(any_of(large).cast("int")).alias("l")).first()
        if not todo["m"] and not todo["l"]:
            break
        if todo["m"]:
            opened = []
            for (i, j), miss in zip(targets, missed):
                low = F.col(t("below", i, j)) >= F.col(t("a", i, j))
                high = F.col(t("below", i, j)) + F.col(t("in", i, j)) < F.col(t("b", i, j))
                opened += [F.when(miss & low, F.col(f"min_{i}")).otherwise(F.col(t("lo", i, j))).alias(t("lo", i, j)),
                           F.when(miss & high, F.col(f"max_{i}")).otherwise(F.col(t("hi", i, j))).alias(t("hi", i, j))]
            brackets = state.select(*[c for c in brackets.columns if c not in names_lo_hi], *opened)
            continue
        held = _with_brackets(base, state, groups, names_lo_hi)
        inner = held.groupBy(*gs).agg(*[x for i, j in targets for x in (
            F.kll_sketch_agg_double(F.when((F.col(vs[i]) > F.col(t("lo", i, j))) & (F.col(vs[i]) < F.col(t("hi", i, j))),
                                           F.col(vs[i])), F.lit(SKETCH)).alias(t("s", i, j)),
            F.count_if(F.col(vs[i]) == F.col(t("lo", i, j))).alias(t("at", i, j)),
            F.count_if((F.col(vs[i]) > F.col(t("lo", i, j))) & (F.col(vs[i]) < F.col(t("hi", i, j)))).alias(t("mid", i, j)))])
        both = _beside(state, inner, groups)
        for (i, j), big in zip(targets, large):
            # rank among the rows strictly inside; one that falls on an end makes the end the bracket
            before = F.col(t("below", i, j)) + F.col(t("at", i, j))
            mid, sketch = F.col(t("mid", i, j)), F.col(t("s", i, j))
            lo_rank, hi_rank = F.col(t("a", i, j)) - before, F.col(t("b", i, j)) - before
            lo = (F.when(lo_rank <= 0, F.col(t("lo", i, j))).when(lo_rank > mid, F.col(t("hi", i, j)))
                  .otherwise(at_rank(sketch, F.floor((lo_rank - 1) / mid * GRID) - margin)))
            hi = (F.when(hi_rank <= 0, F.col(t("lo", i, j))).when(hi_rank > mid, F.col(t("hi", i, j)))
                  .otherwise(at_rank(sketch, F.ceil(hi_rank / mid * GRID) + margin)))
            again += [F.when(big, lo).otherwise(F.col(t("lo", i, j))).alias(t("lo", i, j)),
                      F.when(big, hi).otherwise(F.col(t("hi", i, j))).alias(t("hi", i, j))]
        brackets = both.select(*[c for c in brackets.columns if c not in names_lo_hi], *again)

    # 3. the ranks of the brackets' rows
    held = _with_brackets(base, state, groups, names_lo_hi)
    marks = [((F.col(t("lo", i, j)) < F.col(t("hi", i, j))) & (F.col(vs[i]) >= F.col(t("lo", i, j)))
              & (F.col(vs[i]) <= F.col(t("hi", i, j)))) for i, j in targets]
    cells = [F.when(m, F.struct(F.lit(k).alias("t"), F.col(vs[i]).alias("v"))) for k, ((i, _), m) in enumerate(zip(targets, marks))]
    inside = (held.where(any_of([F.coalesce(m, F.lit(False)) for m in marks]))
              .select(*gs, F.explode(F.filter(F.array(*cells), lambda c: c.isNotNull())).alias("c"))
              .groupBy(*gs, "c.t", "c.v").agg(F.count(F.lit(1)).alias("c")))
    upto = Window.partitionBy(*gs, "t").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)  # MOST rows at most
    ranked = inside.select(*gs, "t", "v", "c", F.sum("c").over(upto).alias("upto"))
    known = state.select(*gs, F.explode(F.array(*[F.struct(
        F.lit(k).alias("t"), F.col(t("a", i, j)).alias("a"), F.col(t("b", i, j)).alias("b"), F.col(t("f", i, j)).alias("f"),
        F.col(t("below", i, j)).alias("below"),
        F.when(F.col(t("lo", i, j)) == F.col(t("hi", i, j)), F.col(t("lo", i, j))).alias("one"))
        for k, (i, j) in enumerate(targets)])).alias("k")).select(*gs, "k.*")
    side = ranked.select(*[F.col(g).alias(f"h{i}") for i, g in enumerate(gs)], F.col("t").alias("ht"), "v", "c", "upto")
    joined = known.join(side, reduce(lambda a, b: a & b, [F.col("t") == F.col("ht"), *([_on(groups)] if groups else [])]), "left")

    def at(rank: str):
        met = (F.col("below") + F.col("upto") >= F.col(rank)) & (F.col("below") + F.col("upto") - F.col("c") < F.col(rank))
        return F.coalesce(F.first("one"), F.max(F.when(met, F.col("v"))))
    values = joined.groupBy(*gs, "t", "f").agg(at("a").alias("va"), at("b").alias("vb"))
    value = F.when(F.col("va") == F.col("vb"), F.col("va")).otherwise(F.col("va") + F.col("f") * (F.col("vb") - F.col("va")))
    m = len(qs)
    out = (values.select(*gs, F.expr(f"t div {m}").cast("int").alias("i"), (F.col("t") % m).alias("j"), value.alias("q"))
           .groupBy(*gs, "i").agg(*[F.max(F.when(F.col("j") == j, F.col("q"))).alias(name) for j, name in enumerate(names)]))
    column = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("i") + 1)
    return out.select(*[F.col(a).alias(g) for g, a in zip(groups, gs)], column.alias("column"), *names)


def exact_quantiles(df: DataFrame, value_col: str, qs: list[float], group_cols: list[str] | None = None,
                    method: str = "linear", names: list[str] | None = None) -> DataFrame:
    """(group..., a column for each quantile) of one column; a group without
    values gives no row."""
    names = names or [f"q{int(round(q * 100)):02d}" for q in qs]
    held = df.where(F.col(value_col).isNotNull())
    return wide_quantiles(held, [value_col], qs, names, group_cols, method).drop("column")


def _beside(left: DataFrame, right: DataFrame, groups: list[str]) -> DataFrame:
    """Two tables of one row a group, side by side."""
    if not groups:
        row = right.first()
        return left.select("*", *[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in right.schema])
    side = right.select(*[F.col(f"g{i}").alias(f"h{i}") for i in range(len(groups))],
                        *[c for c in right.columns if c not in {f"g{i}" for i in range(len(groups))}])
    return left.join(side, _on(groups)).drop(*[f"h{i}" for i in range(len(groups))])
