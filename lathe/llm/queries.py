"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from lathe.llm.ann import op7_ann
from lathe.llm.byte_bpe import op12_byte_bpe
from lathe.llm.lexical_search import op13_lexical_search
from lathe.llm.line_dedup import op2_line_dedup
from lathe.llm.merkle import op11_merkle
from lathe.llm.mixing import op9_mixing
from lathe.llm.ngram_join import op4_ngram_join
from lathe.llm.packing import op10_packing
from lathe.llm.quality_rules import op6_quality_rules
from lathe.llm.suffix_dedup import op1_suffix_dedup
from lathe.llm.token_counts import op3_token_counts
from lathe.llm.url_templates import op8_url_templates
from lathe.llm.warc import op5_warc

QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_line_dedup, op3_token_counts, op4_ngram_join, op5_warc, op6_quality_rules, op7_ann,
    op8_url_templates, op9_mixing, op10_packing, op11_merkle, op12_byte_bpe, op13_lexical_search)}

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE: dict[str, str] = {
    "op13_lexical_search": """
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row,
         unnest(regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS raw FROM documents),
t AS (SELECT doc_id, row, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
sizes AS (SELECT row, count(*) AS n FROM t GROUP BY row),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
tfs AS (SELECT row, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM t GROUP BY row, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM tfs, whole GROUP BY term, docs),
b AS (SELECT item_id, row_number() OVER () AS item,
             unnest(regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS raw FROM benchmark),
asked AS (SELECT DISTINCT item_id, item, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM b),
scores AS (
  SELECT item, any_value(item_id) AS item_id, row, any_value(doc_id) AS doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total)))) AS BIGINT) AS score
  FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN sizes USING (row), whole GROUP BY item, row),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
           FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
    "op2_line_dedup": f"""
WITH l AS (
  SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS k,
         unnest(string_split(coalesce(text, ''), chr(10))) AS raw FROM documents),
u AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS nth, doc_id * 1000000 + k AS place
  FROM (SELECT *, trim(raw, {_BLANKS}) AS s FROM l) WHERE s <> ''),
three AS (
  SELECT doc_id, nth, place, s, lead(s, 1) OVER w AS s2, lead(s, 2) OVER w AS s3 FROM u
  WINDOW w AS (PARTITION BY doc_id ORDER BY nth)),
again AS (
  SELECT doc_id, nth, 3 AS size, place > min(place) OVER (PARTITION BY s, s2, s3) AS later FROM three WHERE s3 IS NOT NULL
  UNION ALL
  SELECT doc_id, nth, 1, place > min(place) OVER (PARTITION BY s) FROM u
  WHERE len(regexp_extract_all(s, '[^\\x20\\x09-\\x0D]+')) >= 50
  UNION ALL
  SELECT doc_id, nth, 2, place > min(place) OVER (PARTITION BY s, s2) FROM three
  WHERE len(regexp_extract_all(s, '[^\\x20\\x09-\\x0D]+')) + len(regexp_extract_all(s2, '[^\\x20\\x09-\\x0D]+')) >= 50),
gone AS (SELECT DISTINCT doc_id, nth + d AS nth FROM again, (VALUES (0), (1), (2)) v(d) WHERE later AND d < size),
marked AS (
  SELECT l.doc_id, l.k, l.raw, u.nth, g.nth AS cut FROM l LEFT JOIN u ON u.doc_id = l.doc_id AND u.k = l.k
  LEFT JOIN gone g ON g.doc_id = u.doc_id AND g.nth = u.nth),
kept AS (
  SELECT doc_id, count(nth) AS n_lines, count(cut) AS n_removed,
         coalesce(string_agg(raw, chr(10) ORDER BY k) FILTER (WHERE cut IS NULL), '') AS rest FROM marked GROUP BY doc_id)
SELECT doc_id, n_lines, n_removed, CASE WHEN text IS NOT NULL THEN sha256(rest) END AS text_sha256
FROM documents JOIN kept USING (doc_id)""",
    "op11_merkle": """
WITH RECURSIVE
-- CRC-32: every byte enters, then eight steps of one bit (-1)
crc AS (SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
    string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda x, b: CASE WHEN b >= 0 THEN xor(x, b) WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS crc
  FROM documents),
fields AS (SELECT doc_id, lang, text,
  CASE WHEN crc % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS changed,
  coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
  || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS front
  FROM crc),
leaves AS (SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS g,
  sha256(front || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
  sha256(front || coalesce(strlen(changed) || ':' || changed, '-')) AS other FROM fields),
ranked AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r FROM leaves),
nodes(g, k, j, h) AS (
  SELECT g, 0, r, leaf FROM ranked UNION ALL
  SELECT g, k + 1, j // 8, sha256(string_agg(h, '' ORDER BY j))
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS c FROM nodes) WHERE c > 1 GROUP BY g, k, j // 8),
subroots AS (SELECT g, arg_max(h, k) AS subroot, row_number() OVER (ORDER BY g) - 1 AS r FROM nodes GROUP BY g),
tops(k, j, h) AS (
  SELECT 0, r, subroot FROM subroots UNION ALL
  SELECT k + 1, j // 8, sha256(string_agg(h, '' ORDER BY j))
  FROM (SELECT *, count(*) OVER () AS c FROM tops) WHERE c > 1 GROUP BY k, j // 8),
beside AS (SELECT g, k, j,
  coalesce(string_agg(h, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(h, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r,
  count(*) OVER (PARTITION BY g, k) AS c
  FROM (SELECT g, k, j, h FROM nodes UNION ALL SELECT NULL, k, j, h FROM tops) WINDOW run AS (PARTITION BY g, k, j // 8 ORDER BY j)),
climb(doc_id, leaf, g, k, j, cur, proof) AS (
  SELECT doc_id, leaf, g, 0, r, other, '' FROM ranked UNION ALL
  SELECT c.doc_id, c.leaf, c.g, c.k + 1, c.j // 8, sha256(b.l || c.cur || b.r), c.proof || b.l || b.r
  FROM climb c JOIN beside b ON b.g = c.g AND b.k = c.k AND b.j = c.j WHERE b.c > 1),
below AS (SELECT c.*, s.subroot, s.r FROM climb c JOIN beside b ON b.g = c.g AND b.k = c.k AND b.j = c.j
  JOIN subroots s ON s.g = c.g WHERE b.c = 1),
ascent(doc_id, leaf, subroot, k, j, cur, proof) AS (
  SELECT doc_id, leaf, subroot, 0, r, cur, proof FROM below UNION ALL
  SELECT c.doc_id, c.leaf, c.subroot, c.k + 1, c.j // 8, sha256(b.l || c.cur || b.r), c.proof || b.l || b.r
  FROM ascent c JOIN beside b ON b.g IS NULL AND b.k = c.k AND b.j = c.j WHERE b.c > 1),
top AS (SELECT arg_max(h, k) AS root, max(k) AS k FROM tops)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified
FROM ascent JOIN top USING (k)""",
    "op5_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT *, strlen(html) AS payload_bytes, max(page_id) OVER (PARTITION BY html) AS largest FROM p),
r AS (SELECT *, payload_bytes >= 1000 AND page_id <> largest AS again FROM q)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN largest END AS refers_to FROM r""",
}
