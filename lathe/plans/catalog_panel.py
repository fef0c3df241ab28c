"""Panel track on ``events`` (user_id plays the listing id, ts the scrape
date, value is unknown on errors, the last event being a purchase is the
label): forward fill, last label, id-grouped split, leakage checks and
fit-on-train imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from lathe.operators import encode, joins, profile, sets, split, windows
from lathe.plans.catalog_profile import events_with_gaps
from lathe.plans.registry import query
from lathe.session import stage_table


def panel_split(spark, sf):
    """Ids stratified by their last known label, rows follow their id."""
    e = events_with_gaps(spark, sf).withColumn("is_purchase", (F.col("event_type") == "purchase").cast("int"))
    return stage_table(split.group_stratified_split(e, "user_id", "ts", "is_purchase", tiebreak="event_id"),
                       "panel-split")


_PANEL_SQL = """
WITH g AS (SELECT event_id, ts, user_id, event_type,
  CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
  CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS is_purchase FROM events),
last AS (SELECT user_id, arg_max(is_purchase, struct_pack(t := ts, e := event_id)) AS lbl FROM g GROUP BY user_id),
r AS (SELECT *, row_number() OVER (PARTITION BY lbl ORDER BY md5(concat_ws('|', CAST(user_id AS VARCHAR), '42')), user_id) AS rk,
             count(*) OVER (PARTITION BY lbl) AS n FROM last),
ids AS (SELECT user_id, CASE WHEN rk <= floor((n * 70 + 50) / 100) THEN 'train'
                             WHEN rk <= floor((n * 85 + 50) / 100) THEN 'val' ELSE 'test' END AS split FROM r),
p AS (SELECT g.*, ids.split FROM g JOIN ids USING (user_id))
"""


@query("w01_forward_fill", """
SELECT event_id, round(last_value(CASE WHEN event_type = 'error' THEN NULL ELSE value END IGNORE NULLS)
       OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS value
FROM events""")
def w01(spark, sf):
    e = events_with_gaps(spark, sf)
    ff = windows.forward_fill(e, "user_id", "ts", ["value"], tiebreak="event_id")
    return ff.select("event_id", F.round("value", 4).alias("value"))


@query("a16_last_by_group", """
SELECT user_id, arg_max(event_type, struct_pack(t := ts, e := event_id)) AS last_event_type
FROM events GROUP BY user_id""")
def a16(spark, sf):
    from lathe.sources.tables import table
    return profile.last_by_group(table(spark, sf, "events"), "user_id", "ts", "event_type",
                                 tiebreak="event_id", out="last_event_type")


@query("d03_group_stratified_split", _PANEL_SQL + "SELECT event_id, user_id, split FROM p")
def d03(spark, sf):
    return panel_split(spark, sf).select("event_id", "user_id", "split")


@query("s02_overlap_check", _PANEL_SQL + """
, per AS (SELECT user_id, list_sort(list(DISTINCT split)) AS s FROM p GROUP BY user_id),
pairs AS (SELECT * FROM (VALUES ('test', 'train'), ('test', 'val'), ('train', 'val')) t(split_a, split_b))
SELECT split_a, split_b, CAST(sum(CASE WHEN list_contains(s, split_a) AND list_contains(s, split_b) THEN 1 ELSE 0 END) AS BIGINT) AS shared_ids
FROM pairs, per GROUP BY split_a, split_b""")
def s02(spark, sf):
    return sets.overlap_check(panel_split(spark, sf), "split", "user_id")


@query("a21_panel_split_shape", _PANEL_SQL + """
SELECT split, count(*) AS rows, count(DISTINCT user_id) AS ids,
       round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS share_pct FROM p GROUP BY split""")
def a21p(spark, sf):
    return profile.split_shape_report(panel_split(spark, sf), "split", "user_id")


@query("k02_semi_join_ids", _PANEL_SQL + """
SELECT event_id FROM events WHERE user_id IN (SELECT user_id FROM ids WHERE split = 'train')""")
def k02(spark, sf):
    from lathe.sources.tables import table
    ids = panel_split(spark, sf).where(F.col("split") == "train").select("user_id")
    return joins.semi_join_ids(table(spark, sf, "events"), ids, "user_id").select("event_id")


@query("e12_median_impute", _PANEL_SQL + """
, med AS (SELECT median(value) AS m FROM p WHERE split = 'train')
SELECT event_id, round(coalesce(value, m), 4) AS value FROM p, med""")
def e12(spark, sf):
    p = panel_split(spark, sf)
    out = encode.median_impute(p.where(F.col("split") == "train"), p, ["value"])
    return out.select("event_id", F.round("value", 4).alias("value"))


@query("e13_missing_flags", _PANEL_SQL + """
SELECT event_id, CAST(value IS NOT NULL AS INTEGER) AS has_value FROM p""")
def e13(spark, sf):
    return encode.missing_flags(panel_split(spark, sf), ["value"]).select("event_id", "has_value")


@query("m36_panel_clean_summary", _PANEL_SQL + """
, ff AS (SELECT *, last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value_ff FROM p),
med AS (SELECT median(value_ff) AS m FROM ff WHERE split = 'train')
SELECT split, count(*) AS rows, CAST(sum(CASE WHEN value_ff IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS still_missing,
       round(avg(coalesce(value_ff, m)), 4) AS mean_value
FROM ff, med GROUP BY split""")
def m36_panel(spark, sf):
    """Classification-track cleaning end to end: grouped split -> forward
    fill inside id -> train median for what is still missing."""
    p = panel_split(spark, sf)
    ff = windows.forward_fill(p, "user_id", "ts", ["value"], tiebreak="event_id")
    ff = ff.withColumn("_miss", F.col("value").isNull().cast("long"))
    imp = encode.median_impute(ff.where(F.col("split") == "train"), ff, ["value"])
    return imp.groupBy("split").agg(F.count(F.lit(1)).alias("rows"),
                                    F.sum("_miss").cast("long").alias("still_missing"),
                                    F.round(F.avg("value"), 4).alias("mean_value"))
