"""Operator 9: mixing sources to target weights by capped water-filling.

Targets start at each source's share by weight.  Sources above ``max_epochs``
times their size are clamped there and the excess is reshared by weight among
the rest, until none is above.  A source's epochs = target / size are served
by that many whole repetitions of every document and one more of a seeded
sample, drawn so that its words meet the fractional rest: documents are dealt
by a hash of id and text into 2**20 cells per source, and running sums over
cells (two levels of 1024) find the cell where the rest is reached.  Only the
rows of that cell are put in order (also where it is large, as with many equal
rows), and a running sum over them ends the sample within half a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lathe.llm.common import stage_table, table
from lathe.operators.ordering import global_row_number, rank_within

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
TOTAL_SHARE = 1.5
MAX_EPOCHS = 2.0
CELLS = 1024


def n_words(text_col: str):
    """Words of a text; none for null."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, total_share: float, max_epochs: float, weights: tuple[float, ...]) -> DataFrame:
    """(source, source_size, target) from (source, source_size): capped
    water-filling.  Each round is one aggregate over the open sources and
    clamps at least one of them or ends."""
    ranked = global_row_number(sizes, [F.col("source").asc_nulls_last()], col="nth")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("nth") - 1) % len(weights) + 1).cast("int"))
    state = stage_table(ranked.select("source", "source_size", weight.alias("weight"),
                                      (F.col("source_size") * max_epochs).alias("cap"),
                                      F.lit(False).alias("full")), "mix-sources")
    total = state.agg(F.sum("source_size")).first()[0] or 0
    while True:
        seen = state.agg(F.sum(F.when(~F.col("full"), F.col("weight"))), F.sum(F.when(F.col("full"), F.col("cap")))).first()
        level = (total_share * total - (seen[1] or 0.0)) / seen[0] if seen[0] else 0.0
        over = ~F.col("full") & (F.col("weight") * level > F.col("cap"))
        if state.where(over).isEmpty():
            break
        state = stage_table(state.withColumn("full", F.col("full") | over), "mix-sources")
    return state.select("source", "source_size",
                        F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * level).alias("target"))


def _cut(cells: DataFrame, key: str, goal: str, names: list[str]) -> DataFrame:
    """The cell of each source where the running sum passes the goal."""
    w = Window.partitionBy("source").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return (cells.withColumn("before", F.coalesce(F.sum("s").over(w), F.lit(0)) + F.col("base"))
            .where(f"before <= {goal} and {goal} < before + s")
            .select("source", F.col(key).alias(names[0]), F.col("before").alias(names[1]), F.col("s").alias(names[2])))


def _dealt(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> list:
    draw = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    return [F.col(source_col).alias("source"), n_words(text_col).alias("size"), draw.alias("draw"),
            F.pmod(F.shiftrightunsigned(draw, 10), F.lit(CELLS)).cast("int").alias("c1"),
            F.pmod(F.shiftrightunsigned(draw, 30), F.lit(CELLS)).cast("int").alias("c2")]


def mixing_plan(narrow: DataFrame, total_share: float = TOTAL_SHARE, max_epochs: float = MAX_EPOCHS,
                weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Per source: size, target, whole repetitions and the cut cell, from
    (source, size, c1, c2) rows."""
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = source_targets(sizes, total_share, max_epochs, weights)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = stage_table(plan.withColumn("whole", whole.cast("long"))
                       .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "mix-plan")
    goals = plan.select(F.col("source").alias("g_source"), "rest")
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    one = narrow.groupBy("source", "c1").agg(F.sum("size").alias("s"))
    cut1 = _cut(one.join(goals, same("source", "g_source")).withColumn("base", F.lit(0)), "c1", "rest",
                ["cut1", "base1", "s1"])
    cut1 = stage_table(cut1.select(F.col("source").alias("k_source"), "cut1", "base1"), "mix-cut")
    two = (narrow.join(cut1, same("source", "k_source") & (F.col("c1") == F.col("cut1")))
           .groupBy("source", "c2", "base1").agg(F.sum("size").alias("s"))
           .join(goals, same("source", "g_source")).withColumnRenamed("base1", "base"))
    cut2 = _cut(two, "c2", "rest", ["cut2", "base2", "s2"]).withColumnRenamed("source", "c_source")
    return stage_table(
        plan.join(cut1, same("source", "k_source"), "left").join(cut2, same("source", "c_source"), "left")
        .select(F.col("source").alias("p_source"), "source_size", "target", "whole", "cut1", "cut2", "base2", "rest"),
        "mix-decided")


def _repeated(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (source, size, draw, c1, c2 and more) with the plan and ``times``,
    how often each is taken."""
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("p_source")))
    at_cut = F.coalesce((F.col("c1") == F.col("cut1")) & (F.col("c2") == F.col("cut2")), F.lit(False))
    before_cut = (F.col("c1") < F.col("cut1")) | ((F.col("c1") == F.col("cut1")) & (F.col("c2") < F.col("cut2")))
    others = joined.where(~at_cut).withColumn("times", F.col("whole") + F.coalesce(before_cut, F.lit(False)).cast("long"))
    cell = joined.where(at_cut).withColumn("copy", F.monotonically_increasing_id())
    ordered = rank_within(cell, ["source"], ["draw", "copy"], count_col=None, sums={"upto": "size"})
    before = F.col("base2") + F.col("upto") - F.col("size")
    taken = before + F.col("size") - F.col("rest") <= F.col("rest") - before
    return others.unionByName(ordered.withColumn("times", F.col("whole") + taken.cast("long")).select(*others.columns))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: int = 7, **limits) -> DataFrame:
    """One row per document: id, source, size, source_size, target, taken.

    A null text has size 0; a null source is a source of its own, last in the
    order of weights; rows with one id or a null id draw by their texts too,
    and equal rows are interchangeable; a source without words has target 0; a
    long text counts whole; an empty table gives no rows; other columns are
    ignored.
    """
    narrow = stage_table(docs.select(F.col(id_col).alias("_id"), *_dealt(docs, id_col, text_col, source_col, seed)),
                         "mix-docs")
    plan = mixing_plan(narrow, **limits)
    return _repeated(narrow, plan).select(F.col("_id").alias(id_col), "source", "size", "source_size", "target",
                                          (F.col("size") * F.col("times")).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    seed: int = 7, **limits) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; nulls, ties and
    empty tables as in ``mix``.  All columns are kept."""
    columns = docs.columns
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"),
                        *_dealt(docs, id_col, text_col, source_col, seed))
    plan = mixing_plan(stage_table(boxed.drop("_row"), "mix-docs"), **limits)
    return (_repeated(boxed, plan).where("times > 0")
            .select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("_row.*"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
