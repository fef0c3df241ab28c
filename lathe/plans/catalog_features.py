"""Feature engineering queries: string/number/date scalars, rule flags and
the fit-on-train encoders and scaler (part, customer, nation, lineitem)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lathe.functions import dates, numeric, rules, text
from lathe.operators import encode, scale, split
from lathe.plans.catalog_profile import LINE_FEATS, events_with_gaps
from lathe.plans.registry import query
from lathe.sources.tables import table

# fixed values: the ordinal code of each part type (E02's explicit map)
TYPE_CODES = {"LARGE": 5, "STANDARD": 4, "MEDIUM": 3, "SMALL": 2, "ECONOMY": 1}
# fixed values: customer segments used as a fixed indicator set
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def part_split(spark, sf):
    """70/15/15 hash split of parts (train = fitting rows for encoders)."""
    return split.stratified_split(table(spark, sf, "part"), "p_partkey")


_PART_SPLIT_SQL = """
WITH r AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', CAST(p_partkey AS VARCHAR), '42')), p_partkey) AS rk,
                  count(*) OVER () AS n FROM part),
ps AS (SELECT * EXCLUDE (rk, n), CASE WHEN rk <= floor((n * 70 + 50) / 100) THEN 'train'
                 WHEN rk <= floor((n * 85 + 50) / 100) THEN 'val' ELSE 'test' END AS split FROM r),
tr AS (SELECT * FROM ps WHERE split = 'train')
"""


def line_split(spark, sf):
    li = table(spark, sf, "lineitem").withColumn(
        "line_key", F.col("l_orderkey") * 100 + F.col("l_linenumber"))
    return split.stratified_split(li, "line_key")


_LINE_SPLIT_SQL = """
WITH b AS (SELECT *, l_orderkey * 100 + l_linenumber AS line_key FROM lineitem),
r AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', CAST(line_key AS VARCHAR), '42')), line_key) AS rk,
                count(*) OVER () AS n FROM b),
ls AS (SELECT * EXCLUDE (rk, n), CASE WHEN rk <= floor((n * 70 + 50) / 100) THEN 'train'
                 WHEN rk <= floor((n * 85 + 50) / 100) THEN 'val' ELSE 'test' END AS split FROM r)
"""


@query("p01_parse_amount", """
SELECT o_orderkey, CAST(replace(CAST(o_custkey AS VARCHAR) || ',' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0'), ',', '') AS DOUBLE) AS amount
FROM orders""")
def p01(spark, sf):
    o = table(spark, sf, "orders")
    raw = F.concat(F.col("o_custkey").cast("string"), F.lit(","),
                   F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0"))
    return o.select("o_orderkey", text.parse_amount(raw).alias("amount"))


@query("p02_parse_price", """
SELECT o_orderkey, TRY_CAST(replace(replace(CASE WHEN o_orderkey % 10 = 0 THEN 'N/A'
       ELSE '$' || CAST(o_custkey AS VARCHAR) || ',' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') || '.50' END, '$', ''), ',', '') AS DOUBLE) AS price
FROM orders""")
def p02(spark, sf):
    o = table(spark, sf, "orders")
    raw = F.when(F.col("o_orderkey") % 10 == 0, F.lit("N/A")).otherwise(
        F.concat(F.lit("$"), F.col("o_custkey").cast("string"), F.lit(","),
                 F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0"), F.lit(".50")))
    return o.select("o_orderkey", text.parse_price(raw).alias("price"))


@query("p03_parse_percent", """
SELECT l_orderkey, l_linenumber, TRY_CAST(replace(CASE WHEN l_returnflag = 'N' THEN 'N/A'
       ELSE CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) || '%' END, '%', '') AS DOUBLE) AS rate
FROM lineitem""")
def p03(spark, sf):
    li = table(spark, sf, "lineitem")
    raw = F.when(F.col("l_returnflag") == "N", F.lit("N/A")).otherwise(
        F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%")))
    return li.select("l_orderkey", "l_linenumber", text.parse_percent(raw).alias("rate"))


@query("p04_non_prefix_count", """
SELECT count(*) FILTER (WHERE NOT starts_with(p_name, 'small')) AS non_prefix, count(*) AS total FROM part""")
def p04(spark, sf):
    p = table(spark, sf, "part")
    return p.agg(F.count_if(text.lacks_prefix("p_name", "small")).alias("non_prefix"),
                 F.count(F.lit(1)).alias("total"))


@query("p06_canonicalize", """
SELECT n_nationkey, CASE WHEN contains(n_name, 'NATION_1') THEN 'group_1x'
                         WHEN contains(n_name, 'NATION_2') THEN 'group_2x'
                         ELSE n_name END AS canonical FROM nation""")
def p06(spark, sf):
    n = table(spark, sf, "nation")
    return n.select("n_nationkey", text.canonicalize("n_name", [("NATION_1", "group_1x"), ("NATION_2", "group_2x")])
                    .alias("canonical"))


_RANGE_TEXT_SQL = """CASE WHEN p_size % 7 = 0 THEN ' ' ELSE '' END || CAST(p_size % 10 AS VARCHAR) || '-' ||
  CAST(p_size % 10 + 3 AS VARCHAR) || CASE WHEN p_size % 2 = 0 THEN ' years' ELSE ' year' END"""


@query("p07_normalize_range_label", f"""
SELECT p_partkey, regexp_replace(trim({_RANGE_TEXT_SQL}), '^(\\d+)-(\\d+)\\s+(years?)$', '\\1 - \\2 \\3') AS label
FROM part""")
def p07(spark, sf):
    p = table(spark, sf, "part")
    raw = F.concat(F.when(F.col("p_size") % 7 == 0, F.lit(" ")).otherwise(F.lit("")),
                   (F.col("p_size") % 10).cast("string"), F.lit("-"), (F.col("p_size") % 10 + 3).cast("string"),
                   F.when(F.col("p_size") % 2 == 0, F.lit(" years")).otherwise(F.lit(" year")))
    return p.select("p_partkey", text.normalize_range_label(raw).alias("label"))


@query("p08_parse_flag", """
SELECT l_orderkey, l_linenumber, l_linestatus = 'F' AS is_final FROM lineitem""")
def p08(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", text.parse_flag("l_linestatus", "F").alias("is_final"))


@query("p09_fill_values", """
SELECT event_id, CASE WHEN event_type = 'error' THEN 0.0 WHEN event_type = 'view' THEN 0.0 ELSE value END AS value,
       coalesce(CASE WHEN event_type = 'view' THEN NULL ELSE props END, '') AS props
FROM events""")
def p09(spark, sf):
    e = events_with_gaps(spark, sf).withColumn(
        "value", F.when(F.col("event_type") == "view", F.lit(float("nan"))).otherwise(F.col("value")))
    filled = numeric.fill_values(e, {"value": 0.0, "props": ""})
    return filled.select("event_id", numeric.fill_nan("value", 0.0).alias("value"), "props")


@query("p10_sum_columns", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice + l_tax, 6) AS total FROM lineitem""")
def p10(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.round(numeric.sum_columns("l_extendedprice", "l_tax"), 6).alias("total"))


@query("p13_days_between", """
SELECT l_orderkey, l_linenumber, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days_to_ship
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def p13(spark, sf):
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select("l_orderkey", "l_linenumber",
                    dates.days_between("l_shipdate", "o_orderdate", fill=0).alias("days_to_ship"))


@query("p15_p16_p17_ratios", """
SELECT l_orderkey, l_linenumber,
       round(l_tax / CASE WHEN l_discount = 0 THEN 1 ELSE l_discount END, 6) AS tax_per_discount,
       round(l_tax / (l_discount + 1), 6) AS tax_smoothed,
       round(l_quantity * l_discount, 6) AS qty_x_disc, round(l_quantity * l_quantity, 6) AS qty_sq
FROM lineitem""")
def p15(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.round(numeric.safe_ratio("l_tax", "l_discount"), 6).alias("tax_per_discount"),
                     F.round(numeric.smoothed_ratio("l_tax", "l_discount"), 6).alias("tax_smoothed"),
                     F.round(numeric.interaction("l_quantity", "l_discount"), 6).alias("qty_x_disc"),
                     F.round(numeric.square("l_quantity"), 6).alias("qty_sq"))


@query("p18_row_mean", """
WITH g AS (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS a,
                  CASE WHEN event_type IN ('view', 'error') THEN NULL ELSE value * 2 END AS b FROM events)
SELECT event_id, round((coalesce(a, 0) + coalesce(b, 0)) / nullif(CAST(a IS NOT NULL AS INTEGER) + CAST(b IS NOT NULL AS INTEGER), 0), 6) AS row_mean
FROM g""")
def p18(spark, sf):
    e = events_with_gaps(spark, sf).select(
        "event_id", F.col("value").alias("a"),
        F.when(F.col("event_type") == "view", F.lit(None)).otherwise(F.col("value") * 2).alias("b"))
    return e.select("event_id", F.round(numeric.row_mean(["a", "b"]), 6).alias("row_mean"))


# fixed values: word-pattern flags over part names (several may fire)
NAME_PATTERNS = {"name_size": "(?i)(small|large|tiny)", "name_colour": "(?i)(red|blue|green)",
                 "name_heat": "(?i)(hot|cold)", "name_tool": "(?i)(gear|bolt|widget)"}


@query("p19_p20_regex_flags", """
SELECT p_partkey, """ + ", ".join(
    f"CAST(regexp_matches(p_name, '{p}') AS INTEGER) AS {n}" for n, p in NAME_PATTERNS.items()) + """,
  least(greatest(1 - (""" + " + ".join(f"CAST(regexp_matches(p_name, '{p}') AS INTEGER)" for p in NAME_PATTERNS.values())
    + """), 0), 1) AS name_other
FROM part""")
def p20(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", *rules.regex_flags("p_name", NAME_PATTERNS))
    return p.select("*", numeric.row_sum_clip(list(NAME_PATTERNS)).alias("name_other"))


# fixed values: exclusive label rules, first match wins
LEVEL_RULES = [("tool", "(?i)(gear|bolt|widget)"), ("sized", "(?i)(small|large)"), ("coloured", "(?i)(red|blue)")]


@query("p21_first_match_label", """
SELECT p_partkey, CASE WHEN p_name IS NULL THEN 'unknown' """ + " ".join(
    f"WHEN regexp_matches(p_name, '{p}') THEN '{lab}'" for lab, p in LEVEL_RULES) + """ ELSE 'other' END AS level
FROM part""")
def p21(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", rules.first_match_label("p_name", LEVEL_RULES).alias("level"))


@query("p23_format_percent", """
WITH r AS (SELECT p_type, round(count(*) * 100.0 / (SELECT count(*) FROM part), 1) AS share FROM part GROUP BY p_type)
SELECT p_type, share, CAST(replace(CAST(share AS VARCHAR) || '%', '%', '') AS DOUBLE) AS share_back FROM r""")
def p23(spark, sf):
    p = table(spark, sf, "part")
    total = p.count()
    g = p.groupBy("p_type").agg(F.round(F.count(F.lit(1)) * 100.0 / F.lit(total), 1).alias("share"))
    return g.select("p_type", "share", text.parse_percent_text(text.format_percent("share", 1)).alias("share_back"))


@query("p24_split_explode_distinct", """
SELECT DISTINCT trim(unnest(string_split(p_name, ' '))) AS token FROM part WHERE p_name IS NOT NULL""")
def p24(spark, sf):
    return text.split_explode_distinct(table(spark, sf, "part"), "p_name", " ")


@query("p25_one_hot_to_label", """
SELECT p_partkey, coalesce(CASE WHEN p_type = 'LARGE' THEN 'large' END, CASE WHEN p_type = 'SMALL' THEN 'small' END,
                           CASE WHEN p_type = 'MEDIUM' THEN 'medium' END, 'Unknown') AS size_label FROM part""")
def p25(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", *rules.one_hot_fixed("p_type", ["LARGE", "SMALL", "MEDIUM"], "t"))
    return p.select("p_partkey", rules.one_hot_to_label(
        {"large": "t_large", "small": "t_small", "medium": "t_medium"}).alias("size_label"))


@query("e02_mapped_ordinal", """
SELECT p_partkey, CAST(CASE p_type """ + " ".join(f"WHEN '{k}' THEN {v}" for k, v in TYPE_CODES.items())
    + """ ELSE -1 END AS INTEGER) AS p_type_ordinal FROM part""")
def e02(spark, sf):
    return encode.mapped_ordinal(table(spark, sf, "part"), "p_type", TYPE_CODES).select("p_partkey", "p_type_ordinal")


@query("e03_frequency_ordinal", _PART_SPLIT_SQL + """
, d AS (SELECT p_type AS k, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS code FROM tr GROUP BY p_type)
SELECT p_partkey, split, CAST(coalesce(code, -1) AS INTEGER) AS p_type_ordinal FROM ps LEFT JOIN d ON ps.p_type = d.k""")
def e03(spark, sf):
    ps = part_split(spark, sf)
    out = encode.frequency_ordinal(ps.where(F.col("split") == "train"), ps, ["p_type"])
    return out.select("p_partkey", "split", "p_type_ordinal")


@query("e04_one_hot_fixed", """
SELECT c_custkey, """ + ", ".join(f"CAST(c_mktsegment = '{s}' AS INTEGER) AS seg_{s.lower()}" for s in SEGMENTS)
    + " FROM customer")
def e04(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", *rules.one_hot_fixed("c_mktsegment", SEGMENTS, "seg"))


@query("e05_one_hot_all", _PART_SPLIT_SQL + """
SELECT p_partkey, """ + ", ".join(
    f"CAST(p_type = '{t}' AS INTEGER) AS p_type_{t.lower()}"
    for t in sorted(["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"])) + " FROM ps")
def e05(spark, sf):
    ps = part_split(spark, sf)
    out = encode.one_hot_all(ps.where(F.col("split") == "train"), ps, "p_type")
    return out.select("p_partkey", *[c for c in out.columns if c.startswith("p_type_")])


# fixed values: preset options for substring and token flags
NAME_OPTIONS = ["red", "blue", "gear", "widget", "small"]


@query("e06_multi_hot_contains", """
SELECT p_partkey, """ + ", ".join(f"CAST(contains(p_name, '{o}') AS INTEGER) AS nm_{o}" for o in NAME_OPTIONS)
    + " FROM part")
def e06(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", *rules.multi_hot_contains("p_name", NAME_OPTIONS, "nm"))


@query("e07_multi_hot_tokens", """
WITH t AS (SELECT p_partkey, list_transform(string_split(coalesce(p_name, ''), ' '), lambda x: trim(x)) AS toks FROM part)
SELECT p_partkey, """ + ", ".join(f"CAST(list_contains(toks, '{o}') AS INTEGER) AS tok_{o}" for o in NAME_OPTIONS)
    + " FROM t")
def e07(spark, sf):
    p = table(spark, sf, "part")
    out = encode.multi_hot_tokens(p, "p_name", NAME_OPTIONS, "tok", sep=" ")
    return out.select("p_partkey", *[f"tok_{o}" for o in NAME_OPTIONS])


def _long(df, key, cols):
    """Wide indicator columns -> ``(key, feature, value)`` (the column set
    depends on the fitted vocabulary, the long form does not)."""
    return df.select(key, *[F.col(c).cast("int").alias(c) for c in cols]).unpivot(
        [key], cols, "feature", "value")


@query("e08_multi_select_flags", _PART_SPLIT_SQL + """
, vocab AS (SELECT DISTINCT trim(unnest(string_split(p_name, ' '))) AS tok FROM tr),
v AS (SELECT tok FROM vocab WHERE tok <> '')
SELECT p_partkey, 'word_' || lower(regexp_replace(tok, '[^a-zA-Z0-9]', '_', 'g')) AS feature,
       CAST(contains(p_name, tok) AS INTEGER) AS value FROM ps, v
UNION ALL
SELECT p_partkey, 'word_count', CAST(len(string_split(p_name, ' ')) AS INTEGER) FROM ps""")
def e08(spark, sf):
    ps = part_split(spark, sf)
    out = encode.multi_select_flags(ps.where(F.col("split") == "train"), ps, "p_name", sep=" ",
                                    prefix="word", count_col="word_count")
    feats = [c for c in out.columns if c.startswith("word_")]
    return _long(out, "p_partkey", feats)


@query("e08_sparse_indicators", """
WITH w AS (SELECT doc_id, unnest(list_distinct(list_filter(string_split_regex(lower(text), '[^a-z]+'), lambda t: t <> ''))) AS name FROM documents),
ix AS (SELECT name, row_number() OVER (ORDER BY name) - 1 AS i FROM (SELECT DISTINCT name FROM w)),
g AS (SELECT doc_id, count(*) AS n_tokens, sum(i) AS index_sum, min(i) AS first_index, max(i) AS last_index FROM w JOIN ix USING (name) GROUP BY doc_id)
SELECT doc_id, (SELECT count(*) FROM ix) AS size, coalesce(n_tokens, 0) AS n_tokens, CAST(index_sum AS BIGINT) AS index_sum,
       CAST(first_index AS INTEGER) AS first_index, CAST(last_index AS INTEGER) AS last_index
FROM documents LEFT JOIN g USING (doc_id)""")
def e08s(spark, sf):
    """Every word of every document as a sparse indicator: the vocabulary is a
    table, and no column is made for a word."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    words = F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda t: t != "")
    rows = encode.sparse_indicators(d, "doc_id", words, encode.fit_token_index(d, words))
    at = F.col("features.indices")
    return rows.select("doc_id", F.col("features.size").cast("long").alias("size"), F.size(at).cast("long").alias("n_tokens"),
                       F.when(F.size(at) > 0, F.aggregate(at, F.lit(0).cast("long"), lambda a, x: a + x)).alias("index_sum"),
                       F.try_element_at(at, F.lit(1)).alias("first_index"), F.try_element_at(at, F.lit(-1)).alias("last_index"))


@query("e09_top_k_one_hot", """
WITH c AS (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey),
r AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', CAST(c_custkey AS VARCHAR), '42')), c_custkey) AS rk,
             count(*) OVER () AS n FROM c),
cs AS (SELECT *, CASE WHEN rk <= floor((n * 70 + 50) / 100) THEN 'train'
                      WHEN rk <= floor((n * 85 + 50) / 100) THEN 'val' ELSE 'test' END AS split FROM r),
top AS (SELECT n_name AS v FROM cs WHERE split = 'train' GROUP BY n_name ORDER BY count(*) DESC, n_name LIMIT 10)
SELECT c_custkey, 'n_name_' || lower(regexp_replace(v, '[^a-zA-Z0-9]', '_', 'g')) AS feature,
       CAST(n_name = v AS INTEGER) AS value FROM cs, top
UNION ALL
SELECT c_custkey, 'n_name_other', CAST(n_name NOT IN (SELECT v FROM top) AS INTEGER) FROM cs""")
def e09(spark, sf):
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    cs = split.stratified_split(c, "c_custkey")
    out = encode.top_k_one_hot(cs.where(F.col("split") == "train"), cs, "n_name", k=10)
    return _long(out, "c_custkey", [x for x in out.columns if x.startswith("n_name_")])


@query("e10_frequency_encode", _PART_SPLIT_SQL + """
, d AS (SELECT p_name AS k, CAST(count(*) AS DOUBLE) AS f FROM tr GROUP BY p_name)
SELECT p_partkey, split, CAST(coalesce(f, 0) AS DOUBLE) AS p_name_freq FROM ps LEFT JOIN d ON ps.p_name = d.k""")
def e10(spark, sf):
    ps = part_split(spark, sf)
    out = encode.frequency_encode(ps.where(F.col("split") == "train"), ps, "p_name")
    return out.select("p_partkey", "split", "p_name_freq")


@query("e10_frequency_encode_normalized", _PART_SPLIT_SQL + """
, d AS (SELECT p_name AS k, count(*) * 1.0 / (SELECT count(*) FROM tr) AS f FROM tr GROUP BY p_name)
SELECT p_partkey, round(coalesce(f, 0), 6) AS p_name_share FROM ps LEFT JOIN d ON ps.p_name = d.k""")
def e10n(spark, sf):
    ps = part_split(spark, sf)
    out = encode.frequency_encode(ps.where(F.col("split") == "train"), ps, "p_name", normalize=True,
                                  out="p_name_share")
    return out.select("p_partkey", F.round("p_name_share", 6).alias("p_name_share"))


@query("e11_route_by_cardinality", _PART_SPLIT_SQL + """
SELECT * FROM (""" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column, count(DISTINCT {c}) AS n_unique,
  CASE WHEN count(DISTINCT {c}) < 2 THEN 'drop' WHEN count(DISTINCT {c}) <= 10 THEN 'frequency_ordinal'
       WHEN count(DISTINCT {c}) <= 30 THEN 'top_k_one_hot' ELSE 'frequency_encode' END AS route FROM tr"""
    for c in ["p_name", "p_brand", "p_type"]) + ")")
def e11(spark, sf):
    ps = part_split(spark, sf)
    return encode.route_by_cardinality(ps.where(F.col("split") == "train"), ["p_name", "p_brand", "p_type"])


@query("e14_standard_scale_fit", _LINE_SPLIT_SQL + """
SELECT * FROM (""" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS feature, round(avg({c}), 6) AS mean,
  round(CASE WHEN stddev_pop({c}) = 0 OR stddev_pop({c}) IS NULL THEN 1.0 ELSE stddev_pop({c}) END, 6) AS std
  FROM ls WHERE split = 'train'""" for c in LINE_FEATS) + ")")
def e14f(spark, sf):
    ls = line_split(spark, sf)
    f = scale.fit_standard_scaler(ls.where(F.col("split") == "train"), LINE_FEATS)
    return f.select("feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query("e14_standard_scale_apply", _LINE_SPLIT_SQL + """
, st AS (SELECT """ + ", ".join(
    f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s_{c}" for c in LINE_FEATS)
    + """ FROM ls WHERE split = 'train')
SELECT line_key, split, """ + ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in LINE_FEATS)
    + " FROM ls, st")
def e14a(spark, sf):
    ls = line_split(spark, sf)
    scaled, _ = scale.standard_scale(ls.where(F.col("split") == "train"), ls, LINE_FEATS)
    return scaled.select("line_key", "split", *[F.round(c, 6).alias(c) for c in LINE_FEATS])


@query("e15_scaled_feature_check", _LINE_SPLIT_SQL + """
, st AS (SELECT """ + ", ".join(
    f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s_{c}" for c in LINE_FEATS)
    + """ FROM ls WHERE split = 'train'),
sc AS (SELECT """ + ", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in LINE_FEATS) + """ FROM ls, st WHERE split = 'train')
SELECT * FROM (""" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std,
  (abs(avg({c})) <= 1e-6 AND (abs(stddev_pop({c}) - 1) <= 1e-6 OR stddev_pop({c}) <= 1e-6)) AS ok FROM sc"""
    for c in LINE_FEATS) + ")")
def e15(spark, sf):
    ls = line_split(spark, sf)
    tr = ls.where(F.col("split") == "train")
    scaled, _ = scale.standard_scale(tr, tr, LINE_FEATS)
    return scale.scaled_feature_check(scaled, LINE_FEATS)
