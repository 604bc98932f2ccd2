"""The registered queries of this subpackage, one per operator, each over its whole table.

``QUERIES`` maps a name to a function of (spark, sf_dir); ``ORACLES`` has the DuckDB SQL of those
that SQL can express.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidemark.llm import compress_quality, credentials, ctw, decontam, infill, langid, licenses, minhash, packing, prefix_trie, quality_rules, simple8b, warc
from tidemark.llm.scratch import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer() -> str:
    """The vocabulary file of the registered queries; operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(name: str, oracle: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return build(spark, sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op4_minhash_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_OP2_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM benchmark WHERE item_id IS NOT NULL),
asked AS (SELECT DISTINCT item_id, size, array_to_string(w[pos:pos + size - 1], ' ') AS phrase
  FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS pos
        FROM (SELECT item_id, w, least(len(w), 10) AS size FROM b WHERE len(w) > 0))),
sizes AS (SELECT DISTINCT size FROM asked),
runs AS (SELECT doc_id, size, pos, array_to_string(w[pos:pos + size - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM d CROSS JOIN sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, item_id, pos, size FROM runs JOIN asked USING (size, phrase)),
hit_words AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS word FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


@query("op2_decontaminate", _OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("items", "spans")


@query("op5_compression_quality")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_quality_rules")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(langid.of_documents(table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")


@query("language_id_pages")
def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(langid.of_pages(table(spark, sf_dir, "pages"))).withColumnRenamed("id", "page_id")


@query("op10_token_files")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple8b.read_token_files(simple8b.write_token_files(table(spark, sf_dir, "documents"), tokenizer()))


@query("op8_pack")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer())


_BITS = "array_to_string(list_transform(range(40), lambda j: substr('0000000100100011010001010110011110001001101010111100110111101111', (4 * instr('0123456789abcdef', substr(h, (j + 1)::INT, 1)) - 3)::INT, 4)), '')"
_OP6_SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
b AS (SELECT page_id, payload_bytes, max(page_id) OVER (PARTITION BY h) AS head, {_BITS} AS bits FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (1 + list_sum(list_transform(range(5), lambda k: substr(bits, (5 * i + k + 1)::INT, 1)::INT * (2 ** (4 - k)))))::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id < head THEN head END AS refers_to
FROM b
"""


@query("op6_warc", _OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages"))).drop("url")


@query("op9_context_tree")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.language_model(table(spark, sf_dir, "documents"))


@query("op7_license_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(licenses.of_documents(table(spark, sf_dir, "documents"))).withColumnRenamed("file_id", "doc_id")


_OP11_SQL = r"""
WITH t AS (SELECT conv_id, x, sha256(length(r) || ':' || r || x) AS digest, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(sha256(length(r) || ':' || r || x), 1, 30)) AS n
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS lender, xor(crc, 4294967295) % 4 AS h FROM (
  SELECT conv_id, list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT),
    lambda acc, b: list_reduce(range(8), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(acc, b)), 4294967295::BIGINT) AS crc
  FROM (SELECT DISTINCT conv_id FROM t))),
lent AS (SELECT c.conv_id, t.n AS d, t.digest, t.x FROM c JOIN t ON t.conv_id = c.lender WHERE t.n <= c.h),
rebuilt AS (SELECT * FROM lent UNION ALL
  SELECT c.conv_id, t.n - c.h + (SELECT count(*) FROM lent WHERE lent.conv_id = c.conv_id) AS d, t.digest, t.x FROM c JOIN t USING (conv_id) WHERE t.n > c.h),
p AS (SELECT conv_id, 0 AS d, '' AS path, '' AS x FROM c UNION ALL SELECT conv_id, d, string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY d) AS path, x FROM rebuilt),
ended AS (SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM (SELECT conv_id, arg_max(path, d) AS path FROM p GROUP BY conv_id) GROUP BY path),
node AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n, (count(*) - 1) * len(regexp_extract_all(any_value(x), '[^\x20\x09-\x0D]+')) AS saved FROM p GROUP BY path, d),
child AS (SELECT left(path, (d - 1) * 64) AS path, count(*) AS n FROM node WHERE d > 0 GROUP BY 1),
below AS (SELECT left(path, a * 64) AS path, sum(saved) AS saved, count(*) FILTER (leaf) AS leaves
  FROM (SELECT path, saved, path NOT IN (SELECT path FROM child) AS leaf, unnest(range(0, d + 1)) AS a FROM node) GROUP BY 1)
SELECT node.conv_id, node.d::BIGINT AS depth, up.conv_id AS parent_conv_id, node.n AS n_convs, coalesce(child.n, 0)::BIGINT AS n_children, below.leaves::BIGINT AS n_leaves, below.saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM node LEFT JOIN node AS up ON up.d = node.d - 1 AND up.path = left(node.path, up.d * 64) LEFT JOIN child ON child.path = node.path JOIN below ON below.path = node.path LEFT JOIN ended ON ended.path = node.path
"""


@query("op11_prefix_trie", _OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


_OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS s FROM documents),
h AS (SELECT doc_id, t, u, len(u) AS n, ('0x' || s[1:8])::UINTEGER % (len(u) + 1) AS x, ('0x' || s[9:16])::UINTEGER % (len(u) + 1) AS y, ('0x' || s[17:24])::UINTEGER % 100 AS z, ('0x' || s[25:32])::UINTEGER % 100 AS w FROM d),
f AS (SELECT doc_id, t, n, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR z >= 50 THEN 'plain' WHEN w < 80 THEN 'spm' ELSE 'psm' END AS form,
  array_to_string(u[1:least(x, y)], '') AS p, array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS m, array_to_string(u[greatest(x, y) + 1:], '') AS q FROM h)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || q || '<M>' || m ELSE '<S>' || q || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM f
"""


@query("op12_infill", _OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digests(infill.infill(infill.frame_store(table(spark, sf_dir, "documents"))))


def _op13_sql() -> str:
    """Every match by its place between the pieces around it, and every pair of parts of a scope compared."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    kinds = [*enumerate(credentials.KINDS), (-1, ("scope", credentials.SCOPE, 0, 1, ""))]
    spans = " UNION ALL ".join(f"""
  SELECT r, {n} AS kind, {quoted(role)} AS role, start, start + length(m) AS stop FROM (
    SELECT r, m, v, coalesce(sum(length(p) + length(m)) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(p) AS start FROM (
      SELECT r, i, f[i] AS m, g[i] AS v, p[i] AS p FROM (
        SELECT r, f, g, p, unnest(range(1, len(f) + 1)) AS i FROM (
          SELECT r, regexp_extract_all(t, {quoted(pattern)}) AS f, regexp_extract_all(t, {quoted(pattern)}, {group}) AS g, string_split_regex(t, {quoted(pattern)}) AS p FROM d WHERE regexp_matches(t, {quoted(pattern)}))))
  ) WHERE length(v) >= {least}""" for n, (_, pattern, group, least, role) in kinds)
    names = " ".join(f"WHEN {n} THEN {quoted(k[0])}" for n, k in enumerate(credentials.KINDS))
    listed = f"string_agg(CASE kind {names} END || ':' || start || ':' || stop, ',' ORDER BY start, kind)"
    strong, reach = credentials.STRONG, credentials.REACH
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
every AS ({spans}),
parts AS (SELECT *, (SELECT count(*) FROM every AS b WHERE b.kind < 0 AND b.r = e.r AND b.start < e.start) AS scope FROM every AS e WHERE kind >= 0),
weak AS (SELECT r, kind, start, stop FROM parts AS w WHERE kind >= {strong}
  AND EXISTS (SELECT 1 FROM parts AS o WHERE o.r = w.r AND o.scope = w.scope AND o.start <= w.stop + {reach} AND o.stop >= w.start - {reach}
    AND (o.start >= w.stop OR o.stop <= w.start) AND (w.role = 'secret') <> (o.role = 'secret'))
  AND NOT EXISTS (SELECT 1 FROM parts AS o WHERE o.r = w.r AND o.kind < {strong} AND o.start < w.stop AND o.stop > w.start)),
shown AS (SELECT r, kind, start, stop FROM parts WHERE kind < {strong} UNION ALL SELECT * FROM weak),
strong AS (SELECT r, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS b, count(*) FILTER (kind = 2) AS c, {listed} AS l FROM parts WHERE kind < {strong} GROUP BY r),
full_list AS (SELECT r, {listed} AS l FROM shown GROUP BY r)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(b, 0)::BIGINT AS n_access, coalesce(c, 0)::BIGINT AS n_hex, sha256(coalesce(strong.l, '')) AS base_sha256, coalesce(full_list.l, '') AS spans
FROM d LEFT JOIN strong USING (r) LEFT JOIN full_list USING (r)
"""


@query("op13_credential_links", _op13_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.secrets(table(spark, sf_dir, "documents"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
