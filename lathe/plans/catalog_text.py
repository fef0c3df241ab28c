"""Text queries: normalisation, length features and fuzzy entity matching
(documents, pages, conversations, part names, customer nations)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lathe.functions import text
from lathe.operators import fuzzy
from lathe.operators.filters import contains_any
from lathe.plans.registry import query
from lathe.sources.tables import table


@query("p05_normalize_text", """
SELECT doc_id, trim(regexp_replace(lower(text), '[^a-zA-Z\\s]', '', 'g'), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS norm
FROM documents""")
def p05(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", text.normalize_text("text", "letters").alias("norm"))


@query("p05_normalize_text_dots", """
SELECT page_id, lower(trim(regexp_replace(url, '\\.', '', 'g'))) AS norm FROM pages""")
def p05d(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", text.normalize_text("url", "dots").alias("norm"))


@query("p05_normalize_text_blanks", """
SELECT doc_id, trim(regexp_replace(lower(chr(9) || text || chr(13) || chr(10)), '[^a-zA-Z\\s]', '', 'g'),
  chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS norm FROM documents""")
def p05b(spark, sf):
    d = table(spark, sf, "documents").withColumn("text", F.concat(F.lit("\t"), "text", F.lit("\r\n")))
    return d.select("doc_id", text.normalize_text("text", "letters").alias("norm"))


@query("p14_text_length_features", """
SELECT doc_id, lang, CAST(strlen(text) AS INTEGER) AS text_length, CAST(len(string_split(text, ' ')) AS INTEGER) AS text_word_count
FROM documents""")
def p14(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "text")
    return text.text_length_features(d, ["text", "not_a_column"], unit="bytes")


@query("p14_text_length_chars", """
SELECT conv_id, turn, CAST(length(text) AS INTEGER) AS text_length, CAST(len(string_split(text, ' ')) AS INTEGER) AS text_word_count
FROM conversations""")
def p14c(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return text.text_length_features(c, ["text"], unit="chars")


def _ratio_sql(words: str, target: str, name: str) -> str:
    """CTEs ending in ``name`` (w, ratio): common blocks found longest first
    (the first in the word), then in the parts before and after them."""
    return f"""
{name}_work(w, a, b, got) AS (
  SELECT w, w, '{target}', 0 FROM {words} UNION ALL
  SELECT w, p.a, p.b, p.got FROM (
    SELECT w, unnest([{{'a': substr(a, 1, i - 1), 'b': substr(b, 1, j - 1), 'got': n}},
                      {{'a': substr(a, i + n), 'b': substr(b, j + n), 'got': 0}}]) AS p
    FROM (SELECT w, a, b, best.n AS n, -best.i AS i, instr(b, substr(a, -best.i, best.n)) AS j
      FROM (SELECT w, a, b, list_max(list_filter(flatten(list_transform(range(1, length(a) + 1), lambda i: list_transform(
              range(1, length(a) - i + 2), lambda n: {{'n': n, 'i': -i}}))), lambda s: contains(b, substr(a, -s.i, s.n)))) AS best
            FROM {name}_work WHERE a <> '' AND b <> '') WHERE best IS NOT NULL))),
{name} AS (SELECT w, 2.0 * sum(got) / (length(w) + {len(target)}) AS ratio FROM {name}_work GROUP BY w)"""


_SPLIT = "list_filter(string_split_regex({text}, '\\s+'), lambda w: w <> '')"


def _bigram_sql(first: str, second: str) -> str:
    """CTEs ending in bi (p_partkey, p_name, is_match)."""
    return f"""
WITH RECURSIVE t AS (SELECT p_partkey, p_name, {_SPLIT.format(text='p_name')} AS ws FROM part),
pairs AS (SELECT p_partkey, ws[i] AS a, ws[i + 1] AS b FROM (SELECT *, unnest(range(1, len(ws))) AS i FROM t WHERE len(ws) BETWEEN 2 AND 6)),
one AS (SELECT DISTINCT a AS w FROM pairs), two AS (SELECT DISTINCT b AS w FROM pairs),
{_ratio_sql('one', first, 'ra')}, {_ratio_sql('two', second, 'rb')},
hit AS (SELECT DISTINCT p_partkey FROM pairs JOIN ra ON ra.w = a JOIN rb ON rb.w = b WHERE (ra.ratio + rb.ratio) / 2 > 0.6),
bi AS (SELECT p_partkey, p_name, p_partkey IN (SELECT p_partkey FROM hit) AS is_match FROM t)"""


@query("u01_fuzzy_word_match", f"""
WITH RECURSIVE t AS (SELECT p_partkey, p_name, {_SPLIT.format(text='lower(p_name)')} AS ws FROM part),
words AS (SELECT DISTINCT unnest(ws) AS w FROM t), {_ratio_sql('words', 'gears', 'r')},
good AS (SELECT list(w) AS ok FROM r WHERE ratio >= 0.6)
SELECT p_partkey, p_name, coalesce(list_has_any(ws, ok), false) AS is_match FROM t, good""")
def u01(spark, sf):
    """Package rule: some word of the part name within 0.6 of 'gears'."""
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    return fuzzy.fuzzy_word_match(p, "p_name", "gears", 0.6).select("p_partkey", "p_name", "is_match")


@query("u02_fuzzy_bigram_match", _bigram_sql("red", "widget") + """
SELECT p_partkey, p_name, is_match FROM bi""")
def u02(spark, sf):
    """Notebook rule on part names: an adjacent word pair close to
    ('red', 'widget') with mean ratio strictly above 0.6."""
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    return fuzzy.fuzzy_bigram_match(p, "p_name", ("red", "widget"), 0.6).select("p_partkey", "p_name", "is_match")


@query("u03_edit_similarity", """
SELECT p_partkey, list_bool_or(list_transform(string_split_regex(lower(p_name), '\\s+'),
       lambda w: 1.0 - levenshtein(w, 'widgets') / greatest(length(w), length('widgets')) >= 0.6)) AS is_close
FROM part""")
def u03(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", fuzzy.edit_similarity("p_name", "widgets", 0.6).alias("is_close"))


@query("u04_fuzzy_recovery_report", _bigram_sql("blue", "gears") + """
SELECT CASE WHEN contains(p_name, 'blue gear') OR contains(p_name, 'red gear') THEN 'exact'
            WHEN is_match THEN 'fuzzy' ELSE 'none' END AS kind, count(*) AS rows, count(DISTINCT p_name) AS values
FROM bi GROUP BY kind""")
def u04(spark, sf):
    """Exact list first, fuzzy bigram ('blue', 'gears') for the rest; rows
    and distinct names recovered by kind."""
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    exact = contains_any("p_name", ["blue gear", "red gear"])
    m = fuzzy.fuzzy_bigram_match(p, "p_name", ("blue", "gears"), 0.6)
    return fuzzy.fuzzy_recovery_report(m, "p_name", exact, "is_match")
