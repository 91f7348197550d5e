"""The queries opN_<name> over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontaminate, fim, host_rules, jaccard, merkle, pii, repeats, secret_scan, training_order, url_filter, warc, word_bpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
#: Key of the training order.
TRAINING_KEY = 20240101


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.find(table(spark, sf_dir, "documents")))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find(table(spark, sf_dir, "documents")))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_passages(table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.round_trip(table(spark, sf_dir, "documents"), RANKS, PATTERN))


def op9_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = training_order.materialise(table(spark, sf_dir, "documents"), RANKS, PATTERN, TRAINING_KEY)
    return training_order.read_shards(manifest).select("slot", "sequence", "n_tokens", "shard", "offset", "tokens_sha256")


def op10_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = host_rules.host_quality(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    manifest = merkle.build(docs, ["doc_id", "source", "lang", "n_chars", "text"], "doc_id", "source", {"text": merkle.lowered(docs["text"], docs["doc_id"])})
    return merkle.digests(merkle.check(manifest))


def op12_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_bpe.digests(word_bpe.round_trip(table(spark, sf_dir, "documents"), WORD_BPE))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(fim.transform(table(spark, sf_dir, "documents")))


OP10_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
win AS (
  SELECT rid, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS p FROM d WHERE len(w) >= 3)),
rep AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT rid, count(DISTINCT q) AS n FROM (SELECT rid, unnest([p, p + 1, p + 2]) AS q FROM rep) GROUP BY rid),
m AS (
  SELECT d.rid, doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN cov ON cov.rid = d.rid),
f AS (
  SELECT *, n_words < 50 AS f1, 100 * n_repeat_words > 50 * n_words AS f2, n_symbols > 1.0 * n_words AS f3, n_dup_lines > 0.1 * n_words AS f4,
         coalesce(word_chars / nullif(n_words, 0)::DOUBLE < 2.0 OR word_chars / nullif(n_words, 0)::DOUBLE > 15.0, false) AS f5
  FROM m),
long AS (
  SELECT source, r, count(*)::DOUBLE AS n, sum(x::INT)::DOUBLE AS k
  FROM (SELECT source, unnest([1, 2, 3, 4, 5]) AS r, unnest([f1, f2, f3, f4, f5]) AS x FROM f WHERE source IS NOT NULL) GROUP BY source, r),
mean AS (SELECT r, sum(k) / sum(n) AS mu, sum(n) AS tot, count(*) AS hosts FROM long GROUP BY r),
var AS (
  SELECT r, any_value(mu) AS mu, (sum(n * (k / n - mu) ** 2) - (any_value(hosts) - 1) * any_value(mu) * (1 - any_value(mu))) / any_value(tot) AS v
  FROM long JOIN mean USING (r) GROUP BY r),
weight AS (SELECT r, mu, CASE WHEN v > 0 THEN least(greatest(mu * (1 - mu) / v - 1, 2.0), 1e6) ELSE 1e6 END AS wt FROM var),
host AS (SELECT source, max((k + mu * wt) / (n + wt)) > 0.5 AS bad FROM long JOIN weight USING (r) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (f1 OR f2) AS base_failed, NOT (f1 OR f2) AND NOT coalesce(bad, false) AS kept
FROM f LEFT JOIN host USING (source)
"""

def _markov(k: str) -> str:
    """Probability of a character under a class's model, as url_filter.score() builds it."""
    p = f"(1.0 / {url_filter.ALPHABET})"
    for n in range(1, url_filter.ORDER + 2):
        seen = f"(SELECT c_{k} FROM model WHERE gram = '')" if n == 1 else f"coalesce(h{n - 1}.c_{k}, 0)"
        p = f"((coalesce(g{n}.n_{k}, 0) + {url_filter.BETA} * {p}) / ({seen} + {url_filter.BETA}))"
    return p


_LEN = url_filter.ORDER + 1
OP3_SQL = rf"""
WITH parts AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                      regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
rows AS (SELECT *, host || path AS text, CASE WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/' WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS ruled FROM parts),
texts AS (SELECT text, max(ruled) AS verdict FROM rows WHERE text <> '' GROUP BY text),
lab AS (SELECT *, substr(md5('held ' || text), 1, 1) IN ('0', '1', '2') AS held FROM texts WHERE verdict IS NOT NULL),
chars AS (SELECT text, {", ".join(f"substr(p, i + {url_filter.ORDER} - {n} + 1, {n}) AS x{n}" for n in range(1, _LEN + 1))}, {", ".join(f"substr(p, i + {url_filter.ORDER} - {n}, {n}) AS y{n}" for n in range(1, _LEN))}
  FROM (SELECT text, repeat(chr(2), {url_filter.ORDER}) || text AS p, unnest(range(1, length(text) + 1)) AS i FROM texts)),
train AS (SELECT verdict, chars.* FROM chars JOIN lab USING (text) WHERE NOT held),
counts AS (SELECT verdict, unnest([{", ".join(f"x{n}" for n in range(1, _LEN + 1))}]) AS gram, 1 AS n, 0 AS c FROM train UNION ALL SELECT verdict, unnest(['', {", ".join(f"y{n}" for n in range(1, _LEN))}]), 0, 1 FROM train),
model AS (SELECT gram, {", ".join(f"sum({x}) FILTER (verdict = '{k}') AS {x}_{k}0, coalesce({x}_{k}0, 0)::DOUBLE AS {x}_{k}" for x in "nc" for k in ("allow", "block"))} FROM counts GROUP BY gram),
score AS (SELECT text, avg(ln({_markov("allow")}) - ln({_markov("block")})) AS score FROM chars
  {" ".join(f"LEFT JOIN model g{n} ON g{n}.gram = x{n}" for n in range(1, _LEN + 1))} {" ".join(f"LEFT JOIN model h{n} ON h{n}.gram = y{n}" for n in range(1, _LEN))} GROUP BY text),
fit AS (SELECT verdict, avg(score) AS m, stddev_pop(score) AS s FROM score JOIN lab USING (text) WHERE held GROUP BY verdict),
cut AS (SELECT CASE WHEN a.s + b.s > 0 THEN (a.m * b.s + b.m * a.s) / (a.s + b.s) ELSE (a.m + b.m) / 2 END AS t FROM fit a, fit b WHERE a.verdict = 'allow' AND b.verdict = 'block')
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN text = '' OR score >= coalesce((SELECT t FROM cut), 0) THEN 'allow' ELSE 'block' END) AS verdict FROM rows LEFT JOIN score USING (text)
"""

OP5_SQL = """
WITH p AS (SELECT row_number() OVER () AS rid, page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h HAVING count(*) > 1 AND min(page_id) IS NOT NULL),
hex AS (SELECT rid, page_id, n, h, first, unnest(range(8)) AS i FROM p LEFT JOIN f USING (h)),
v AS (SELECT *, list_sum([(strpos('0123456789abcdef', substr(h, (1 + 5 * i + j)::INT, 1)) - 1) * (16 ** (4 - j)) for j in range(5)])::BIGINT AS x FROM hex),
d AS (SELECT rid, string_agg(array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (1 + (x // (32 ** (3 - k))::BIGINT) % 32)::INT, 1) for k in range(4)], ''), '' ORDER BY i) AS digest,
  any_value(page_id) AS page_id, any_value(n)::BIGINT AS n, any_value(first) AS first FROM v GROUP BY rid)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to FROM d
"""

OP6_SQL = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '\S+') AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
win AS (SELECT doc_id, p, md5(array_to_string(list_slice(w, p, p + 49), ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM t WHERE len(w) >= 50)),
shared AS (SELECT g FROM win GROUP BY g HAVING count(DISTINCT doc_id) > 1),
hit AS (SELECT DISTINCT doc_id, p - 1 AS s FROM win WHERE g IN (SELECT g FROM shared)),
run AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS r FROM (SELECT *, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 50 THEN 0 ELSE 1 END AS fresh FROM hit))
SELECT doc_id, min(s)::INTEGER AS start_word, (max(s) + 50)::INTEGER AS end_word, (max(s) + 50 - min(s))::INTEGER AS n_words FROM run GROUP BY doc_id, r
"""

OP8_SQL = r"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '\S+') AS w FROM documents WHERE doc_id IS NOT NULL),
g AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(list_slice(w, p, p + 4), ' ') END AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM t WHERE len(w) > 0)),
k AS (SELECT doc_id, count(*) AS n, md5(string_agg(s, '~' ORDER BY s)) AS h FROM g GROUP BY doc_id),
link AS (SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id JOIN k x ON x.doc_id = a.doc_id JOIN k y ON y.doc_id = b.doc_id
         GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING count(*) >= 0.8 * (x.n + y.n - count(*)) - 1e-9),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
SELECT t.doc_id, least(t.doc_id, (SELECT min(b) FROM reach WHERE reach.a = t.doc_id)) AS class_id,
  (SELECT count(DISTINCT y.h) FROM link JOIN k x ON x.doc_id = link.a JOIN k y ON y.doc_id = link.b WHERE link.a = t.doc_id AND x.h <> y.h) AS n_links,
  coalesce((SELECT count(*) - 1 FROM k x JOIN k y ON y.h = x.h WHERE x.doc_id = t.doc_id), 0)::BIGINT AS n_copies
FROM t
"""

_VALUE = lambda c: f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || ({c}::VARCHAR), '-')"
_LEAF = " || ".join(map(_VALUE, ("doc_id", "source", "lang", "n_chars", "{text}")))
_CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), [1::BIGINT, 2, 3, 4, 5, 6, 7, 8]), lambda v, i: xor(v >> 1, (v & 1) * 3988292384))), 4294967295)"


def _grown(name: str, leaves: str) -> str:
    """A tree's nodes by level, and beside each node the hashes left and right of it in its run."""
    return f"""
{name}(tree, level, i, cnt, h) AS (SELECT tree, 0, i, n, h FROM {leaves} UNION ALL
  SELECT tree, level + 1, i // 16, (cnt + 15) // 16, sha256(string_agg(h, '' ORDER BY i)) FROM {name} WHERE cnt > 1 GROUP BY tree, level, i // 16, cnt),
{name}_sides AS (SELECT tree, level, i, coalesce(string_agg(h, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(h, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name} WHERE cnt > 1 WINDOW r AS (PARTITION BY tree, level, i // 16 ORDER BY i))"""


OP11_SQL = f"""
WITH RECURSIVE raw AS (SELECT row_number() OVER () AS rid, doc_id, coalesce('1' || source, '0') AS tree, sha256({_LEAF.format(text="text")}) AS h,
  CASE WHEN doc_id IS NOT NULL AND {_CRC} % 5 = 0 THEN sha256({_LEAF.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) ELSE h END AS seen FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM raw),
{_grown("node", "leaves")},
subs AS (SELECT '' AS tree, tree AS source, h, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM node WHERE cnt = 1),
{_grown("apex", "subs")},
steps AS (
  SELECT rid, s.level AS k, s.l, s.r FROM leaves x, unnest(range(12)) AS t(level) JOIN node_sides s ON s.tree = x.tree AND s.level = t.level AND s.i = x.i // (16 ** t.level)::BIGINT
  UNION ALL SELECT rid, 100 + s.level, s.l, s.r FROM leaves x JOIN subs b ON b.source = x.tree, unnest(range(12)) AS t(level) JOIN apex_sides s ON s.level = t.level AND s.i = b.i // (16 ** t.level)::BIGINT),
proof AS (SELECT rid, string_agg(l || r, '' ORDER BY k) AS text, list(l || '|' || r ORDER BY k) AS sides FROM steps GROUP BY rid)
SELECT doc_id, x.h AS leaf, b.h AS subroot, whole.h AS root, sha256(coalesce(text, '')) AS proof_sha256,
  list_reduce(list_prepend(seen, coalesce(sides, [])), lambda a, s: sha256(split_part(s, '|', 1) || a || split_part(s, '|', 2))) AS folded_root, folded_root = root AS verified
FROM leaves x JOIN subs b ON b.source = x.tree LEFT JOIN proof USING (rid), (SELECT h FROM apex WHERE cnt = 1) whole
"""

OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
  regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
x AS (SELECT *, len(u)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS b,
  ('0x' || substr(h, 17, 8))::BIGINT % 100 AS r, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS q FROM d),
f AS (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r >= 50 THEN 'plain' WHEN q < 80 THEN 'spm' ELSE 'psm' END AS form,
  array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m, array_to_string(u[greatest(a, b) + 1:], '') AS s FROM x)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM f
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_secret_scan": op2_secret_scan,
    "op3_url_filter": op3_url_filter,
    "op4_pii": op4_pii,
    "op5_warc": op5_warc,
    "op6_repeated_passages": op6_repeated_passages,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_training_order": op9_training_order,
    "op10_host_rules": op10_host_rules,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_word_bpe": op12_word_bpe,
    "op13_fill_in_middle": op13_fill_in_middle,
}
SQL: dict[str, str] = {"op3_url_filter": OP3_SQL, "op5_warc": OP5_SQL, "op6_repeated_passages": OP6_SQL, "op8_jaccard_join": OP8_SQL, "op10_host_rules": OP10_SQL, "op11_merkle_manifest": OP11_SQL, "op13_fill_in_middle": OP13_SQL}
