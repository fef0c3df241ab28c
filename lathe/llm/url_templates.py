"""Operator 8: URL filters from a path-template tree, in DataFrame functions only.

Per host, paths are generalised level by level.  A segment whose labelled share
of bad pages differs significantly from its parent's stays literal; one with
few rows gives way to its shape (digit runs as ``#``) if that differs, and
stays by itself only if its own labels turn the parent's verdict.  All others
are merged into the wildcard ``*``, so only branches that say something of
their own stay apart, however small a share of the host they are.  A template
is rejected when its labelled purity, smoothed towards the share of good pages
of the whole table, is below a threshold.  Fixed rules come first; the longest
that fits wins.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.llm.common import stage_table, table

RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
SMOOTHING, MIN_PURITY = 10.0, 0.5


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(rest, upper, lower), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, prefix, says in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        rule = F.when(fits, F.lit(name + prefix)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _stats() -> list[Column]:
    return [F.count("*").alias("n"), F.count("bad").alias("seen"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")]


def _prior(row) -> float:
    """Share of good pages over all labelled ones (1 if none is labelled)."""
    return 1 - row["bad"] / row["seen"] if row["seen"] else 1.0


def _purity(seen: Column, bad: Column, smoothing: float, prior: float) -> Column:
    return (seen - bad + smoothing * prior) / (seen + smoothing)


def _branches(state: DataFrame, value: str, parents: DataFrame, min_rows: int, z_apart: float,
              prior: float) -> DataFrame:
    """Branches with enough rows, and smaller ones whose labels turn their
    parent's verdict; apart if their bad share stands apart from its."""
    nodes = state.where(f"{value} is not null").groupBy("host", "template", value).agg(*_stats())
    p = F.col("p_bad") / F.col("p_seen")
    error = F.sqrt(p * (1 - p) * (1 / F.col("seen") - 1 / F.col("p_seen")))
    apart = ((F.col("seen") > 0) & (F.col("seen") < F.col("p_seen")) & (error > 0)
             & (F.abs(F.col("bad") / F.col("seen") - p) > z_apart * error))
    turned = ((_purity(F.col("seen"), F.col("bad"), SMOOTHING, prior) < MIN_PURITY)
              != (_purity(F.col("p_seen"), F.col("p_bad"), SMOOTHING, prior) < MIN_PURITY))
    many = F.col("n") >= min_rows
    return (nodes.join(parents, ["host", "template"]).where(many | (apart & turned))
            .select(F.col("host").alias(f"{value}_host"), F.col("template").alias(f"{value}_template"),
                    F.col(value).alias(f"{value}_value"), apart.alias(f"{value}_apart"), many.alias(f"{value}_many")))


def path_templates(paths: DataFrame, min_rows: int = 20, z_apart: float = 2.58) -> DataFrame:
    """Adds the template to (id, host, path, bad) rows.  Levels run on as long
    as some node can still part: no branch's z is above the root of its
    parent's labelled rows, and these only get fewer from level to level, so
    below the last such level every segment is a wildcard."""
    state = stage_table(paths.select("id", "host", "path", "bad", F.split("path", "/").alias("segments"))
                        .withColumn("template", F.lit("")), "url-tree")
    prior = _prior(state.agg(*_stats()).first())
    for level in count(1):
        segment = F.when(F.size("segments") > level, F.col("segments")[level])
        state = state.withColumn("seg", segment).withColumn("shape", F.regexp_replace("seg", "[0-9]+", "#"))
        parents = (state.where("seg is not null").groupBy("host", "template").agg(*_stats())
                   .where((F.col("bad") > 0) & (F.col("bad") < F.col("seen")) & (F.col("seen") > z_apart ** 2))
                   .select("host", "template", F.col("seen").alias("p_seen"), F.col("bad").alias("p_bad")))
        if parents.isEmpty():
            break
        for value in ("seg", "shape"):
            found = _branches(state, value, parents, min_rows, z_apart, prior)
            state = state.join(found, (F.col("host") == F.col(f"{value}_host"))
                               & (F.col("template") == F.col(f"{value}_template"))
                               & (F.col(value) == F.col(f"{value}_value")), "left")
        step = (F.when(F.col("seg_many"), F.when(F.col("seg_apart"), F.col("seg")).otherwise(F.lit("*")))
                .when(F.col("shape_apart"), F.col("shape"))
                .when(F.col("seg_apart"), F.col("seg")).otherwise(F.lit("*")))
        template = F.when(F.col("seg").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), step))
        state = stage_table(state.select("id", "host", "path", "bad", "segments", template.alias("template")), "url-tree")
    tail = F.repeat(F.lit("/*"), F.greatest(F.size("segments") - level, F.lit(0)))
    return state.select("id", "host", "path", F.concat("template", tail).alias("template"), "bad")


def template_verdicts(templates: DataFrame, smoothing: float = SMOOTHING,
                      min_purity: float = MIN_PURITY) -> DataFrame:
    """(host, template, purity, rejected): labelled purity smoothed towards the
    share of good pages over all labelled ones (1 if none is labelled)."""
    nodes = templates.groupBy("host", "template").agg(*_stats())
    prior = _prior(nodes.agg(F.sum("seen").alias("seen"), F.sum("bad").alias("bad")).first())  # two numbers
    return (nodes.withColumn("purity", _purity(F.col("seen"), F.col("bad"), smoothing, prior))
            .select("host", "template", "purity", (F.col("purity") < min_purity).alias("rejected")))


def judge_urls(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url",
               rules=RULES, **tree) -> DataFrame:
    """page id, host, path, rule, verdict, template.

    ``labels`` has doc_id, quality, toxic: a page with the label's id is bad if
    it is toxic or of quality 0.  Several labels of one id count as bad if any
    is; null labels say nothing.  A null url, or one without ``://``, has empty
    host and path, fits no rule, and is judged with the other such urls; rows
    are judged one by one, so repeated rows and null ids stay; paths are judged
    at any depth; an empty table gives no rows.
    """
    url = F.col(url_col)
    base = pages.select(F.col(id_col).alias("id"), url_host(url).alias("host"), url_path(url).alias("path"))
    bad = F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).when(
        F.col("toxic").isNotNull() | F.col("quality").isNotNull(), 0)
    known = labels.select(F.col("doc_id").alias("l_id"), bad.alias("b")).where("l_id is not null and b is not null")
    known = known.groupBy("l_id").agg(F.max("b").alias("bad"))
    paths = stage_table(base.join(known, F.col("id") == F.col("l_id"), "left").select("id", "host", "path", "bad"),
                        "url-paths")
    leaves = path_templates(paths, **tree)
    placed = leaves.join(template_verdicts(leaves), ["host", "template"])
    rule, said = matching_rule(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))
    return placed.select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"),
                         F.coalesce(said, learned).alias("verdict"), "template", "purity")


def op8_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
