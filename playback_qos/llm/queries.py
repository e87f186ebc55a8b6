"""The registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playback_qos.llm import pii, simhash
from playback_qos.llm.bpe import encode_documents
from playback_qos.llm.centroids import cluster
from playback_qos.llm.common import table
from playback_qos.llm.decontaminate import decontaminate
from playback_qos.llm.jaccard_join import near_duplicates
from playback_qos.llm.language_id import held_out, identify, train
from playback_qos.llm.line_dedup import MIN_PAGES, RATIO, drop_boilerplate
from playback_qos.llm.quality import fit_weights, quality
from playback_qos.llm.sharding import shard_documents
from playback_qos.llm.substring_dedup import remove_repeated_windows
from playback_qos.llm.warc import roundtrip
from playback_qos.llm.whitening import whiten

PIECE_MODEL = "piece_bpe_32k.model"


def piece_model_path() -> str:
    """Where the installed vocabulary file is."""
    import public_tokenizers

    return public_tokenizers.path(PIECE_MODEL)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_windows(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.sanitise(table(spark, sf_dir, "documents"))
    told = F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    kinds = F.transform("spans", lambda s: s["kind"])
    n_base = F.size(F.filter(kinds, lambda x: x != "term"))
    return found.select(
        "doc_id",
        *[F.size(F.filter(kinds, lambda x: x == F.lit(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS],  # noqa: B023
        F.sha2(F.array_join(F.slice(told, 1, n_base), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(told, ",").alias("spans"),
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality(docs, fit_weights(docs, table(spark, sf_dir, "labels"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_ratio"
    )


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "group_id", "n_links")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roundtrip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    return identify(docs, model, keep=["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected"
    )


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), piece_model_path()).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        "doc_id", "source", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


LLM_QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_decontamination,
        op3_sharding,
        op4_pii,
        op5_quality,
        op6_jaccard_join,
        op7_warc,
        op8_language_id,
        op9_sentencepiece,
        op10_line_dedup,
        op11_centroids,
        op12_simhash,
        op13_whitening,
    )
}

OP1_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), wins AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)
), least AS (
  SELECT k, min(doc_id) AS m FROM wins GROUP BY k
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p
  FROM wins JOIN least USING (k) WHERE m < doc_id
), each_word AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w
), kept AS (
  SELECT e.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY e.p) AS t
  FROM each_word e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.p = g.p
  WHERE g.p IS NULL GROUP BY e.doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT item_id, ws, least(13, len(ws)) AS n FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark) WHERE len(ws) > 0
), bw AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS k
  FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS i FROM b)
), dw AS (
  SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS k
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM b) WHERE len(ws) >= n)
), m AS (
  SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.n = bw.n
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id
), it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM m) GROUP BY doc_id
)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  (coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws)) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""

OP7_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, p.payload_digest,
  CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS NOT DISTINCT FROM first THEN NULL ELSE first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest
"""

OP3_SQL = r"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t
), rows_ AS (
  SELECT doc_id, coalesce(text, '') AS body,
    list_max(list_transform(range(40), lambda s: {'h': md5(concat_ws(':', doc_id::VARCHAR, s::VARCHAR)), 's': s})) AS b,
    md5(concat_ws(':', doc_id::VARCHAR, '40')) AS extra,
    substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 2) AS bucket
  FROM documents
), crc AS (
  SELECT *, (strlen(body) + 16)::BIGINT AS size,
    xor(list_reduce(list_concat([4294967295::BIGINT],
      list_transform(regexp_extract_all(hex(encode(body)), '..'), lambda x: ('0x' || x)::BIGINT)),
      lambda c, x: xor(c // 256, t[(xor(c, x) % 256) + 1])), 4294967295::BIGINT) AS text_crc32
  FROM rows_, crc_table
)
SELECT doc_id, size, text_crc32::BIGINT AS text_crc32, 'key' AS law, b.s::INTEGER AS shard,
  (row_number() OVER (PARTITION BY b.s ORDER BY bucket, doc_id NULLS FIRST, size, text_crc32) - 1)::BIGINT AS slot,
  (CASE WHEN extra > b.h THEN 40 ELSE b.s END)::INTEGER AS grown_shard
FROM crc
"""

OP10_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents
), held AS (
  SELECT source, l, count(*) AS n
  FROM (SELECT source, unnest(list_distinct(ls)) AS l FROM d)
  WHERE regexp_matches(l, '[^ \t\n\x0B\f\r]') GROUP BY source, l
), boiler AS (
  SELECT h.source, list(l) AS bad
  FROM held h JOIN (SELECT source, count(*) AS total FROM d GROUP BY source) t
    ON h.source IS NOT DISTINCT FROM t.source
  WHERE n >= {MIN_PAGES} AND n > {RATIO} * total GROUP BY h.source
), cut AS (
  SELECT d.*, CASE WHEN bad IS NULL THEN ls ELSE list_filter(ls, lambda x: NOT list_contains(bad, x)) END AS kept
  FROM d LEFT JOIN boiler b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, source, coalesce(len(ls), 0)::BIGINT AS n_lines,
  coalesce(len(ls) - len(kept), 0)::BIGINT AS n_dropped,
  sha256(array_to_string(kept, chr(10))) AS kept_sha256
FROM cut
"""



def _op11_sql(k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64) -> str:
    def assigned(i: int) -> str:
        square = f"list_sum(list_transform(range(1, {dim + 1}), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))::BIGINT"
        return f"a{i} AS MATERIALIZED (SELECT r, min({{'d': {square}, 'c': c.c}}) AS best FROM v, c{i} c GROUP BY r)"

    def moved(i: int) -> str:
        return f"""m{i} AS (
  SELECT c, list(m ORDER BY i) AS x FROM (
    SELECT best.c AS c, i, ((sum(x[i]) - ((sum(x[i]) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS m
    FROM (SELECT best, x, unnest(range(1, {dim + 1})) AS i FROM a{i} JOIN v USING (r)) GROUP BY best.c, i) GROUP BY c
), c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(m{i}.x, c{i}.x) AS x FROM c{i} LEFT JOIN m{i} ON c{i}.c = m{i}.c)"""

    steps = ", ".join(f"{assigned(i)}, {moved(i)}" for i in range(rounds))
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda z: floor({scale} * z::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE len(embedding) = {dim}
    AND len(list_filter(embedding, lambda z: z IS NOT NULL AND isfinite(z))) = {dim}
), c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY h, x) - 1)::INTEGER AS c, x
  FROM (SELECT sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS h, x FROM v ORDER BY h, x LIMIT {k})
), {steps}, {assigned(rounds)}, inertias AS (
  SELECT best.c AS c, sum(best.d)::BIGINT AS own FROM a{rounds} GROUP BY best.c
)
SELECT vec_id, best.c AS cluster, best.d AS distance, own AS cluster_inertia,
  (SELECT sum(own)::BIGINT FROM inertias) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM v JOIN a{rounds} USING (r) JOIN inertias ON inertias.c = best.c JOIN c{rounds} c ON c.c = best.c
"""


OP11_SQL = _op11_sql()

LLM_ORACLE_SQL = {
    "op1_substring_dedup": OP1_SQL,
    "op2_decontamination": OP2_SQL,
    "op3_sharding": OP3_SQL,
    "op7_warc": OP7_SQL,
    "op10_line_dedup": OP10_SQL,
    "op11_centroids": OP11_SQL,
}
