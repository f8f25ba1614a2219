"""Queries ``op1_`` to ``op13_`` and their SQL, where SQL can express them."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeworks.llm.decontam import contamination
from lodgeworks.llm.dialogue import repair
from lodgeworks.llm.knn_join import voronoi_topk
from lodgeworks.llm.minhash import edited_fingerprints
from lodgeworks.llm.mixing import mix_sources
from lodgeworks.llm.quality import fit_quality, held_out, score_quality
from lodgeworks.llm.secrets import BASE_KINDS, find_secrets, of_kinds
from lodgeworks.llm.shards import assign_shards, text_bytes
from lodgeworks.llm.simhash import as_hex, near_duplicates
from lodgeworks.llm.spelling import group_variants, word_counts
from lodgeworks.llm.tokens import ids_round_trip
from lodgeworks.llm.urls import filter_urls
from lodgeworks.llm.warc import archive_round_trip

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

# The rules of op3.
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def _query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op1_mix_sources")
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents").select("doc_id", "source"))


@_query("op2_quality_classifier")
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, _table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


_RULES_SQL = ", ".join(f"('{v}', '{r}')" for v, r in URL_RULES)


@_query("op3_url_filter", rf"""
WITH u AS (
  SELECT page_id,
    coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), '') AS raw_host,
    coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path FROM pages),
h AS (SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM u),
r AS (SELECT v, r, r[:strpos(r, '/') - 1] AS rh, r[strpos(r, '/'):] AS rp FROM (VALUES {_RULES_SQL}) t(v, r)),
m AS (SELECT h.*, r.r AS rule, r.v FROM h LEFT JOIN r ON (h.host = r.rh OR ends_with(h.host, '.' || r.rh)) AND starts_with(h.path, r.rp))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM m
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) = 1
""")
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = filter_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


_SHARDS_SQL = """
WITH s AS (SELECT doc_id, (coalesce(strlen(text), 0) + 1)::BIGINT AS size FROM documents),
p AS (SELECT doc_id, size, sum(size) OVER (ORDER BY doc_id) - size AS before, sum(size) OVER () AS total FROM s),
q AS (SELECT doc_id, size, least(15, ((2 * before + size) * 16) // (2 * total))::INTEGER AS shard FROM p)
SELECT doc_id, size, 'bytes' AS law, shard,
  (row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM q
"""


@_query("op4_shard_documents")
def op4_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", text_bytes().alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    return assign_shards(docs, 16, size=F.col("size")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


_GROUPS_SQL = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((((('0x' || substr(hex, {10 * g + 1}, 10))::BIGINT) >> {s}) & 31) + 1)::INTEGER, 1)"
    for g in range(4) for s in range(35, -1, -5)
)


@_query("op5_warc_revisits", f"""
WITH d AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
x AS (SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex,
  min(page_id) OVER (PARTITION BY payload) AS original FROM d)
SELECT page_id, payload_bytes, {_GROUPS_SQL} AS payload_digest,
  CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to
FROM x
""")
def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = archive_round_trip(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query("op6_secret_scan")
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(of_kinds((kind,))).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(k) for k in BASE_KINDS],
        F.sha2(F.array_join(of_kinds(BASE_KINDS), ","), 256).alias("base_sha256"),
        F.array_join("secrets", ",").alias("spans"))


@_query("op7_simhash_near_dedup")
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", as_hex().alias("fingerprint"), "component_id")


@_query("op8_token_ids")
def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = ids_round_trip(_table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return back.select("doc_id", "start", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@_query("op9_voronoi_topk", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT q.vec_id AS query_id, (row_number() OVER w)::INTEGER AS rank, c.vec_id AS vec_id,
  list_inner_product(q.v, c.v)::BIGINT AS score
FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
WINDOW w AS (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v, c.v) DESC, c.vec_id)
QUALIFY row_number() OVER w <= 5
""")
def op9_voronoi_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double"))
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    # Vectors that take no part keep their components, so that the operator can tell them.
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    vectors = vectors.withColumn("embedding", F.when(F.coalesce(finite, F.lit(False)), whole))
    return voronoi_topk(vectors, F.col("vec_id") % 50 == 0, 5)


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@_query("op10_decontamination", rf"""
WITH b AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
g AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i + 1 : i + 10], ' ') AS gram
  FROM (SELECT item, w, unnest(range(greatest(len(w) - 9, least(len(w), 1)))) AS i FROM b)),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(greatest(len(w) - n + 1, 0))) AS i FROM d, (SELECT DISTINCT n FROM g))),
h AS (SELECT doc_id, i, g.n, item FROM s JOIN g ON s.gram = g.gram AND s.n = g.n),
c AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY 1),
t AS (SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
""")
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def worn(doc: str, run: str) -> str:
    """The run without one code point, for one occurrence in 199."""
    h = zlib.crc32(f"{doc}:{run}".encode())
    if h % 199:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


@_query("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = word_counts(_table(spark, sf_dir, "documents").select("doc_id", "text"), alter=worn)
    return group_variants(words)


@_query("op12_document_fingerprints")
def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with rows dropped, emptied, cut, repeated and given to the user, by a checksum of id and turn."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", word("conv_id"), word("turn")).cast("binary")) % 20
    hit = rows.select("conv_id", "turn", word("role").alias("role"), word("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    out = hit.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "kind")
    return out.select("*", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("kind", "col")


@_query("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    report = repair(damaged(rows)).report()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    every = rows.select("conv_id").distinct().alias("l")
    found = every.join(report.alias("r"), F.col("l.conv_id").eqNullSafe(F.col("r.conv_id")), "left")
    return found.select(
        "l.conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
