"""Registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; executors have the same package installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeline.llm.packing import pack

    return pack(_read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), 2048)


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeline.llm.order_minhash import near_classes

    return near_classes(_read(spark, sf_dir, "documents"), 0.8)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeline.llm.sentencepiece_scan import decode, encode

    path = vocabulary("piece_bpe_32k.model")
    docs = _read(spark, sf_dir, "documents")
    ids = decode(encode(docs, path), path)
    return ids.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_ids"), F.crc32("ids").alias("ids_crc32"), "score",
        F.crc32(F.encode("decoded", "UTF-8")).alias("decoded_crc32"), F.octet_length("decoded").cast("long").alias("decoded_bytes"), "ids")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeline.llm.token_files import count_tokens, flat_blocks

    return count_tokens(flat_blocks(_read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json")))


def op5_fm_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeline.llm.fm_substrings import remove_repeated_windows

    return remove_repeated_windows(_read(spark, sf_dir, "documents"), 35).drop("kept_text")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeline.llm.suffix_dedup import remove_later_copies

    return remove_later_copies(_read(spark, sf_dir, "documents"), 50).drop("kept_text")


def op7_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeline.llm.importance import resample

    return resample(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op8_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeline.llm.multi_index import nearest

    return nearest(_read(spark, sf_dir, "embeddings"), every=20, neighbours=20)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeline.llm.url_trie import judge_urls

    return judge_urls(_read(spark, sf_dir, "pages"), URL_RULES)


def op10_pstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeline.llm.pstable import near_vectors

    return near_vectors(_read(spark, sf_dir, "embeddings"), 0.95)


def op11_size_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeline.llm.size_shards import assign

    return assign(_read(spark, sf_dir, "documents"), 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeline.llm.fill_middle import fill_in_middle, restore

    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return fill_in_middle(_read(spark, sf_dir, "documents")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
        digest(restore(F.col("output"), F.col("form"))).alias("restored_sha256"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeline.llm.token_alignment import align

    digest = lambda groups: F.when(groups == "", "").otherwise(F.sha2(groups.cast("binary"), 256))
    return align(_read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"), digest) \
        .withColumnRenamed("groups", "groups_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}


_URL_SQL = """
WITH split AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), named AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1) AS path
  FROM split
), rules(verdict, h, p) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), best AS (
  SELECT n.page_id, n.host, n.path, max_by(struct_pack(r := h || p, v := verdict), length(h || p)) AS hit
  FROM named n LEFT JOIN rules r
    ON (n.host = r.h OR ends_with(n.host, '.' || r.h)) AND starts_with(n.path, r.p)
  GROUP BY ALL
)
SELECT page_id, host, path, hit.r AS rule, coalesce(hit.v, 'allow') AS verdict FROM best
"""


# CRC-32 byte by byte; its table follows from the polynomial
_SHARD_SQL = """
WITH crc AS (
  SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)
), sized AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 8 AS size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS bytes
  FROM documents
), summed AS (
  SELECT doc_id, size,
    xor(list_reduce([4294967295::BIGINT] || bytes, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32,
    sum(size) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - size AS before, sum(size) OVER () AS total
  FROM sized, crc
), cut AS (
  SELECT doc_id, size, text_crc32, ((2 * before + size) * 24 // (2 * total))::INT AS shard FROM summed
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, NULL::INT AS grown_shard
FROM cut
"""

_MIDDLE_SQL = """
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS tokens
  FROM documents
), drawn AS (
  SELECT *, len(tokens) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
    ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM split
), parts AS (
  SELECT doc_id, text, n,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
         WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(tokens[:least(h1 % (n + 1), h2 % (n + 1))], '') AS prefix,
    array_to_string(tokens[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS middle,
    array_to_string(tokens[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') AS suffix
  FROM drawn
)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                   ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
FROM parts
"""


def oracle_sql() -> dict[str, str]:
    return {"op9_url_filter": _URL_SQL, "op11_size_shards": _SHARD_SQL, "op12_fill_middle": _MIDDLE_SQL}
