"""Profiling, projection, filter, set and ordering queries on the
dimension tables (part, customer, supplier, nation), lineitem and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from lathe.operators import filters, profile, project, sets, windows
from lathe.plans.registry import query
from lathe.sources import files
from lathe.sources.tables import table

LINE_FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def events_with_gaps(spark, sf):
    """events with NULLs derived by a fixed rule: ``value`` is unknown on
    errors, ``props`` on views."""
    e = table(spark, sf, "events")
    return e.select("event_id", "ts", "user_id", "event_type",
                    F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value")).alias("value"),
                    F.when(F.col("event_type") == "view", F.lit(None)).otherwise(F.col("props")).alias("props"))


_GAPS_SQL = """WITH g AS (SELECT event_id, ts, user_id, event_type,
  CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
  CASE WHEN event_type = 'view' THEN NULL ELSE props END AS props FROM events)
"""


@query("a01_null_profile", _GAPS_SQL + """
SELECT * FROM (
  SELECT 'value' AS column, count(*) FILTER (WHERE value IS NULL) AS null_count,
         round(count(*) FILTER (WHERE value IS NULL) * 100.0 / count(*), 4) AS null_pct FROM g
  UNION ALL
  SELECT 'props', count(*) FILTER (WHERE props IS NULL), round(count(*) FILTER (WHERE props IS NULL) * 100.0 / count(*), 4) FROM g
) WHERE null_count > 0""")
def a01(spark, sf):
    return profile.null_profile(events_with_gaps(spark, sf))


@query("a02_describe_table", """
SELECT * FROM (
""" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column, count({c}) AS count, count(*) FILTER (WHERE {c} IS NULL) AS null_count,
  round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min,
  round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50,
  round(quantile_cont({c}, 0.75), 4) AS p75, round(max({c}), 4) AS max FROM lineitem"""
    for c in LINE_FEATS) + ")")
def a02(spark, sf):
    return profile.describe_table(table(spark, sf, "lineitem"), LINE_FEATS)


@query("a03_value_counts_top", """
SELECT p_brand, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM part), 4) AS pct
FROM part GROUP BY p_brand ORDER BY count DESC, p_brand LIMIT 10""")
def a03(spark, sf):
    return profile.value_counts(table(spark, sf, "part"), "p_brand", n=10, pct=True)


@query("a04_n_unique", """
SELECT 'p_name' AS column, CAST(count(DISTINCT p_name) AS BIGINT) AS n_unique FROM part
UNION ALL SELECT 'p_brand', count(DISTINCT p_brand) FROM part
UNION ALL SELECT 'p_type', count(DISTINCT p_type) FROM part
UNION ALL SELECT 'p_size', count(DISTINCT p_size) FROM part""")
def a04(spark, sf):
    return profile.n_unique(table(spark, sf, "part"), ["p_name", "p_brand", "p_type", "p_size"])


@query("a05_distinct_values", "SELECT DISTINCT p_type FROM part")
def a05(spark, sf):
    return profile.distinct_values(table(spark, sf, "part"), "p_type")


@query("a10_class_balance", """
SELECT quality, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS pct,
       round(max(count(*)) OVER () * 1.0 / min(count(*)) OVER (), 4) AS imbalance_ratio
FROM labels GROUP BY quality""")
def a10(spark, sf):
    return profile.class_balance(table(spark, sf, "labels"), "quality")


def docs_labelled(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")


@query("a11_rate_by_category", """
WITH long AS (
  SELECT 'source' AS feature, source AS category, quality FROM documents JOIN labels USING (doc_id)
  UNION ALL SELECT 'lang', lang, quality FROM documents JOIN labels USING (doc_id)),
g AS (SELECT feature, category, CAST(sum(quality) AS BIGINT) AS positives, count(*) AS total,
             round(sum(quality) * 100.0 / count(*), 4) AS rate_pct FROM long GROUP BY feature, category),
r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY rate_pct DESC, category) AS rn FROM g)
SELECT feature, category, positives, total, rate_pct FROM r WHERE rn <= 5 AND total > 1""")
def a11(spark, sf):
    return profile.rate_by_category(docs_labelled(spark, sf), ["source", "lang"], F.col("quality") == 1)


@query("a12_mean_diff_by_class", "SELECT * FROM (" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS feature, round(avg({c}) FILTER (WHERE l_linestatus = 'F'), 4) AS mean_pos,
  round(avg({c}) FILTER (WHERE l_linestatus <> 'F'), 4) AS mean_neg,
  round(avg({c}) FILTER (WHERE l_linestatus = 'F') - avg({c}) FILTER (WHERE l_linestatus <> 'F'), 4) AS diff,
  round((avg({c}) FILTER (WHERE l_linestatus = 'F') - avg({c}) FILTER (WHERE l_linestatus <> 'F')) * 100.0
        / nullif(avg({c}) FILTER (WHERE l_linestatus <> 'F'), 0), 4) AS diff_pct FROM lineitem"""
    for c in LINE_FEATS) + ")")
def a12(spark, sf):
    return profile.mean_diff_by_class(table(spark, sf, "lineitem"), LINE_FEATS, F.col("l_linestatus") == "F")


@query("a13_group_means", """
SELECT quality, round(avg(length(text)), 4) AS mean_text_chars,
       round(avg(len(string_split(text, ' '))), 4) AS mean_text_words
FROM documents JOIN labels USING (doc_id) GROUP BY quality""")
def a13(spark, sf):
    from lathe.functions.text import text_length, word_count
    d = docs_labelled(spark, sf).select("quality", text_length("text", "chars").alias("text_chars"),
                                        word_count("text").alias("text_words"))
    return profile.group_means(d, ["quality"], ["text_chars", "text_words"])


@query("a14_correlation_matrix", """
WITH c AS (SELECT """ + ", ".join(
    f"corr({a}, {b}) AS r_{i}_{j}" for i, a in enumerate(LINE_FEATS) for j, b in enumerate(LINE_FEATS) if j >= i)
    + """ FROM lineitem)
SELECT * FROM (""" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(r_{min(i, j)}_{max(i, j)}, 6) AS r FROM c"
    for i, a in enumerate(LINE_FEATS) for j, b in enumerate(LINE_FEATS)) + ")")
def a14(spark, sf):
    return profile.correlation_matrix(table(spark, sf, "lineitem"), LINE_FEATS)


@query("a15_target_correlation_topk", """
WITH t AS (SELECT *, CASE WHEN l_linestatus = 'F' THEN 1.0 ELSE 0.0 END AS y FROM lineitem),
c AS (SELECT * FROM (""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, corr({c}, y) AS r FROM t" for c in LINE_FEATS + ["l_linenumber"]) + """))
SELECT feature, round(r, 6) AS r, round(abs(r), 6) AS abs_r FROM c ORDER BY abs(r) DESC, feature LIMIT 3""")
def a15(spark, sf):
    li = table(spark, sf, "lineitem")
    return profile.target_correlation_topk(li, F.col("l_linestatus") == "F", LINE_FEATS + ["l_linenumber"], 3)


@query("a17_duplicate_report", """
SELECT text, count(*) AS copies FROM documents GROUP BY text HAVING count(*) > 1""")
def a17(spark, sf):
    return profile.duplicate_report(table(spark, sf, "documents").select("text"))


@query("a17_duplicate_rows", """
SELECT doc_id, text, lang, source FROM documents
QUALIFY count(*) OVER (PARTITION BY text, lang, source) > 1""")
def a17r(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return profile.duplicate_rows(d, ["text", "lang", "source"])


@query("a18_drop_duplicates", "SELECT DISTINCT text, lang FROM documents")
def a18(spark, sf):
    return profile.drop_duplicates(table(spark, sf, "documents").select("text", "lang"))


# fixed values: the long-name -> short-name map of the customer snapshot
CUSTOMER_MAP = {"c_custkey": "key", "c_name": "name", "c_nationkey": "nationkey",
                "c_acctbal": "acctbal", "c_mktsegment": "segment"}
SUPPLIER_MAP = {"s_suppkey": "key", "s_name": "name", "s_nationkey": "nationkey", "s_acctbal": "acctbal"}


@query("j01_rename_columns", """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment
FROM customer""")
def j01(spark, sf):
    return project.rename_columns(table(spark, sf, "customer"), CUSTOMER_MAP)


@query("j02_select_mapped", """
SELECT c_custkey AS key, c_name AS name, c_acctbal AS acctbal FROM customer""")
def j02(spark, sf):
    kept, _dropped = project.select_mapped(table(spark, sf, "customer"),
                                           {"c_custkey": "key", "c_name": "name", "c_acctbal": "acctbal"})
    return kept


@query("j03_drop_existing", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def j03(spark, sf):
    return project.drop_existing(table(spark, sf, "customer"), ["c_name", "c_mktsegment", "c_not_there"])


@query("j04_infer_feature_roles", """
WITH n AS (SELECT count(*) AS total, count(DISTINCT text) + max(CASE WHEN text IS NULL THEN 1 ELSE 0 END) AS nu_text,
                  count(DISTINCT lang) + max(CASE WHEN lang IS NULL THEN 1 ELSE 0 END) AS nu_lang,
                  count(DISTINCT source) + max(CASE WHEN source IS NULL THEN 1 ELSE 0 END) AS nu_source FROM documents)
SELECT 'doc_id' AS column, 'bigint' AS dtype, CAST(NULL AS BIGINT) AS n_unique, 'numeric' AS role
UNION ALL SELECT 'text', 'string', nu_text, CASE WHEN nu_text < 100 OR nu_text * 1.0 / total < 0.1 THEN 'categorical' ELSE 'text' END FROM n
UNION ALL SELECT 'lang', 'string', nu_lang, CASE WHEN nu_lang < 100 OR nu_lang * 1.0 / total < 0.1 THEN 'categorical' ELSE 'text' END FROM n
UNION ALL SELECT 'source', 'string', nu_source, CASE WHEN nu_source < 100 OR nu_source * 1.0 / total < 0.1 THEN 'categorical' ELSE 'text' END FROM n
UNION ALL SELECT 'n_chars', 'bigint', NULL, 'numeric'""")
def j04(spark, sf):
    return project.infer_feature_roles(table(spark, sf, "documents"))


@query("j05_horizontal_concat", """
SELECT p_partkey, p_size, p_retailprice, p_name, p_type FROM part""")
def j05(spark, sf):
    p = table(spark, sf, "part")
    return project.horizontal_concat(p.select("p_partkey", "p_size", "p_retailprice"),
                                     p.select("p_partkey", "p_name", "p_type"), "p_partkey")


@query("j06_project_literal_flags", """
SELECT o_orderkey, 'orders' AS source, CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 0 ELSE -1 END AS status_flag
FROM orders""")
def j06(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", F.lit("orders").alias("source"),
                    F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0)
                    .otherwise(-1).alias("status_flag"))


_SNAP_SQL = """
SELECT key, name, nationkey, acctbal, segment, snapshot FROM (
  SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment, 1 AS snapshot FROM customer
  UNION ALL BY NAME
  SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal, 2 AS snapshot FROM supplier)"""


@query("s01_union_all_by_name", _SNAP_SQL)
def s01(spark, sf):
    c = project.rename_columns(table(spark, sf, "customer"), CUSTOMER_MAP).withColumn("snapshot", F.lit(1))
    s = project.rename_columns(table(spark, sf, "supplier"), SUPPLIER_MAP).withColumn("snapshot", F.lit(2))
    return sets.union_all_by_name([c, s])


@query("i02_read_snapshots", """
SELECT key, name, nationkey, acctbal, snapshot FROM (""" + _SNAP_SQL + ")")
def i02(spark, sf):
    return files.read_snapshots(spark, [f"{sf}/customer.parquet", f"{sf}/supplier.parquet"],
                                renames=[CUSTOMER_MAP, SUPPLIER_MAP], drop=["segment"], fmt="parquet")


@query("s03_set_difference", """
SELECT l_orderkey FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_quantity > 25) a
WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_orderkey = a.l_orderkey AND b.l_discount > 0.05)""")
def s03(spark, sf):
    li = table(spark, sf, "lineitem")
    bulk = li.where(F.col("l_quantity") > 25).select("l_orderkey").distinct()
    return sets.set_difference(bulk, li.where(F.col("l_discount") > 0.05), "l_orderkey")


@query("f03_drop_nulls", _GAPS_SQL + "SELECT event_id FROM g WHERE value IS NOT NULL")
def f03(spark, sf):
    return filters.drop_nulls(events_with_gaps(spark, sf), ["value"]).select("event_id")


@query("f04_drop_all_nulls_report", _GAPS_SQL + """
SELECT count(*) AS rows_before, count(*) FILTER (WHERE value IS NOT NULL AND props IS NOT NULL) AS rows_after,
       count(*) - count(*) FILTER (WHERE value IS NOT NULL AND props IS NOT NULL) AS rows_lost FROM g""")
def f04(spark, sf):
    _kept, report = filters.drop_all_nulls(events_with_gaps(spark, sf))
    return report


@query("f05_filter_regex_not", """
SELECT doc_id FROM documents WHERE NOT regexp_matches(text, '(?i)licen[cs]e|copyright')""")
def f05(spark, sf):
    return filters.filter_regex_not(table(spark, sf, "documents"), "text", "licen[cs]e|copyright") \
        .select("doc_id")


@query("f08_filter_in_list", """
SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag IN ('A', 'R')""")
def f08(spark, sf):
    return filters.filter_in_list(table(spark, sf, "lineitem"), "l_returnflag", ["A", "R"]) \
        .select("l_orderkey", "l_linenumber")


@query("f08_filter_in_computed_list", """
WITH top AS (SELECT o_custkey FROM orders GROUP BY o_custkey ORDER BY count(*) DESC, o_custkey LIMIT 10)
SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM top)""")
def f08c(spark, sf):
    o = table(spark, sf, "orders")
    top = windows.top_k_values(o, "o_custkey", 10).select("o_custkey")
    return filters.filter_in_list(o, "o_custkey", top).select("o_orderkey")


@query("f09_filter_text_length", """
SELECT conv_id, turn FROM conversations WHERE text IS NOT NULL AND length(text) > 0 AND length(text) <= 200""")
def f09(spark, sf):
    return filters.filter_text_length(table(spark, sf, "conversations"), "text", 200).select("conv_id", "turn")


@query("f10_contains_any", """
SELECT doc_id, (contains(text, 'MIT License') OR contains(text, 'Apache') OR contains(text, 'GPL')) AS has_license
FROM documents""")
def f10(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", filters.contains_any("text", ["MIT License", "Apache", "GPL"]).alias("has_license"))


@query("f11_anti_filter", """
SELECT event_id FROM events WHERE NOT coalesce(event_type = 'error' OR value > 400, false)""")
def f11(spark, sf):
    e = table(spark, sf, "events")
    return filters.anti_filter(e, (F.col("event_type") == "error") | (F.col("value") > 400)).select("event_id")


@query("w02_top_k_values", """
SELECT p_brand, count(*) AS count FROM part GROUP BY p_brand ORDER BY count DESC, p_brand LIMIT 5""")
def w02(spark, sf):
    return windows.top_k_values(table(spark, sf, "part"), "p_brand", 5)


@query("w03_frequency_rank", """
SELECT l_suppkey, count(*) AS count, CAST(row_number() OVER (ORDER BY count(*) DESC, l_suppkey) - 1 AS INTEGER) AS code
FROM lineitem GROUP BY l_suppkey""")
def w03(spark, sf):
    return windows.frequency_rank(table(spark, sf, "lineitem"), "l_suppkey")


@query("w04_top_n", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 10""")
def w04(spark, sf):
    return windows.top_n(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"),
                         ["o_totalprice", "o_orderkey"], 10)


@query("w04_bottom_n", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10""")
def w04b(spark, sf):
    return windows.bottom_n(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"),
                            ["o_totalprice", "o_orderkey"], 10)


@query("w05_arg_best", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 1""")
def w05(spark, sf):
    return windows.arg_best(table(spark, sf, "orders"), "o_totalprice", ["o_orderkey", "o_totalprice"],
                            how="min", tiebreak="o_orderkey")


@query("w06_top_k_per_group", """
SELECT l_returnflag, line_key, l_extendedprice, rank FROM (
  SELECT l_returnflag, l_orderkey * 100 + l_linenumber AS line_key, l_extendedprice,
         row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey * 100 + l_linenumber) AS rank
  FROM lineitem) WHERE rank <= 3""")
def w06(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_returnflag", (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("line_key"), "l_extendedprice")
    out = windows.top_k_per_group(li, ["l_returnflag"], [F.col("l_extendedprice").desc()], 3, tiebreak="line_key")
    return out.withColumn("rank", F.col("rank").cast("bigint"))


@query("k01_join_features", """
SELECT l_orderkey, l_linenumber, o_orderpriority, o_orderstatus
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def k01(spark, sf):
    from lathe.operators.joins import join_features
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority", "o_orderstatus")
    return join_features(li, o, "l_orderkey")


@query("k03_map_encode_join", """
WITH d AS (SELECT n_nationkey AS k, n_regionkey AS v FROM nation)
SELECT c_custkey, CAST(coalesce(v, -1) AS INTEGER) AS region_code FROM customer LEFT JOIN d ON c_nationkey = d.k""")
def k03(spark, sf):
    from lathe.operators.joins import map_encode_join
    d = table(spark, sf, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_regionkey").alias("value"))
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    out = map_encode_join(c, "c_nationkey", d, "region_code", default=-1)
    return out.select("c_custkey", F.col("region_code").cast("int"))


@query("a15_leakage_check", """
WITH t AS (SELECT *, ln(1 + l_extendedprice) AS y, l_extendedprice * 1.0 AS raw_target FROM lineitem)
SELECT * FROM (""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, round(corr({c}, y), 6) AS r, abs(corr({c}, y)) > 0.99 AS leak FROM t"
    for c in ["l_quantity", "l_discount", "l_tax", "raw_target"]) + ")")
def a15l(spark, sf):
    """The regression track's leakage guard: the raw target
    sits among the features of its log1p transform."""
    li = table(spark, sf, "lineitem").withColumn("raw_target", F.col("l_extendedprice") * 1.0)
    return profile.leakage_check(li, F.log1p("l_extendedprice"), ["l_quantity", "l_discount", "l_tax", "raw_target"],
                                 threshold=0.99)
