"""The registered query of each training-data operator and, where SQL can express it, its DuckDB form."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from ledgerloom.llm import (
    bit_sliced,
    cap_filters,
    chunk_dedup,
    line_dedup,
    merge_replay,
    pairwise_quality,
    periodic_runs,
    sharding,
    simhash_grid,
    source_schedule,
    string_kernel,
    token_alignment,
    token_files,
)
from ledgerloom.llm.common import WORD, documents, id_crc, text_or_empty
from ledgerloom.session import scratch_path


def op1_sharding(spark, sf_dir):
    return sharding.interleaved_shards(documents(spark, sf_dir), shards=40, seed=7)


def op2_token_files(spark, sf_dir):
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(
        documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"), vocabulary=50_257, end_id=0
    )
    return token_files.document_checksums(spark, path)


def op3_exact_dedup(spark, sf_dir):
    return chunk_dedup.exact_dedup(documents(spark, sf_dir))


def op4_line_dedup(spark, sf_dir):
    docs = documents(spark, sf_dir)
    bitmaps = line_dedup.recurring_line_bitmaps(docs, min_docs=10, min_length=1)
    kept = line_dedup.apply_line_bitmaps(docs, bitmaps)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_near_vectors(spark, sf_dir):
    return cap_filters.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), least_cosine=0.93)


def op6_quality(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return pairwise_quality.quality_scores(documents(spark, sf_dir), labels, threshold=0.3)


def op7_simhash(spark, sf_dir):
    return simhash_grid.near_duplicates(documents(spark, sf_dir), words=4, seed=42, max_bits=4)


def op8_mixing(spark, sf_dir):
    return source_schedule.mix_sources(documents(spark, sf_dir), weights=(5, 2, 1), share=1.5, most=2.0, seed=11)


def byte_bpe_digests(docs):
    """Encode, decode, and digest what came out of both."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return merge_replay.encode_documents(docs, ranks, public_tokenizers.PATTERN, decoded=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("content", 256).alias("decoded_sha256"),
    )


def op9_byte_bpe(spark, sf_dir):
    return byte_bpe_digests(documents(spark, sf_dir))


def op10_language(spark, sf_dir):
    return string_kernel.predict_languages(documents(spark, sf_dir))


def op11_top_products(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return bit_sliced.top_products(vectors, F.col("vec_id") % 50 == 0, k=5, scale=256.0)


def op12_token_alignment(spark, sf_dir):
    aligned = token_alignment.align_tokenizers(
        documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), digests=True
    )
    return aligned.withColumnRenamed("groups", "groups_sha256")


def with_periodic_tails(docs):
    """In every tenth document by id the words from a place on repeat the first few of them."""
    h = id_crc()
    g = F.floor(h / 10)
    words = F.when(h % 10 == 0, F.regexp_extract_all(text_or_empty(), F.lit(f"({WORD})"), F.lit(1)))
    split = docs.select("doc_id", "text", g.alias("_g"), words.alias("_words")).withColumn("_n", F.size("_words"))
    start = F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")).cast("int")
    split = split.withColumn("_start", start).withColumn("_left", F.col("_n") - F.col("_start"))
    period = (1 + F.floor(F.col("_left") / (3 + F.col("_g") % 8))).cast("int")
    head = F.slice("_words", F.lit(1), F.col("_start"))
    repeat = F.flatten(F.array_repeat(F.slice("_words", F.col("_start") + 1, period), F.ceil(F.col("_left") / period).cast("int")))
    tailed = F.array_join(F.concat(head, F.slice(repeat, F.lit(1), F.col("_left"))), " ")
    return split.select("doc_id", F.when(F.col("_n") > 0, tailed).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark, sf_dir):
    found = periodic_runs.periodic_runs(with_periodic_tails(documents(spark, sf_dir)), least=12)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length, (-r.start).alias("start"), (-r.period).alias("period"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.withColumn("_longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_longest.start")).alias("start"),
        F.col("_longest.length").alias("length"),
        (-F.col("_longest.period")).alias("period"),
        F.expr("1000 * _longest.length DIV -_longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_token_files": op2_token_files,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_near_vectors": op5_near_vectors,
    "op6_quality": op6_quality,
    "op7_simhash": op7_simhash,
    "op8_mixing": op8_mixing,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_language": op10_language,
    "op11_top_products": op11_top_products,
    "op12_token_alignment": op12_token_alignment,
    "op13_periodic_runs": op13_periodic_runs,
}

# crc32 has no DuckDB function: the polynomial's table is built and the bytes are folded through it.
OP1_SQL = """
WITH polynomial AS (
  SELECT list(c ORDER BY n) AS crcs
  FROM (SELECT n, list_reduce(list_prepend(n, range(8)),
                              lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) t(n))
), rows_in AS (
  SELECT doc_id, source, coalesce(text, '') AS text, coalesce('1' || source, '0') AS mark FROM documents
), summed AS (
  SELECT doc_id, source, mark, sha256(text) AS text_hash, strlen(text) + 16 AS size,
         xor(list_reduce(list_prepend(4294967295::BIGINT,
                 list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda pair: ('0x' || pair)::BIGINT)),
             lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM rows_in, polynomial
), weighed AS (
  SELECT *, sum(size) OVER () AS total, sum(size) OVER (PARTITION BY text_hash) * 40 > sum(size) OVER () AS alone,
         row_number() OVER (PARTITION BY doc_id, source, text_hash) - 1 AS copy
  FROM summed
), shuffled AS (
  SELECT *, md5(concat_ws(':', '7', coalesce(doc_id::VARCHAR, 'null'), CASE WHEN alone THEN copy ELSE 0 END, text_hash)) AS digest FROM weighed
), in_units AS (
  SELECT *, CASE WHEN alone THEN text_hash || digest || mark ELSE text_hash END AS unit FROM shuffled
), units AS (
  SELECT unit, any_value(total) AS total, sum(size)::BIGINT AS bytes, min(digest || mark)[:32] AS digest, min(digest || mark)[33:] AS mark
  FROM in_units GROUP BY unit
), ranked AS (
  SELECT *, bytes * 64 * 40 > total AS is_big,
         (row_number() OVER (PARTITION BY mark ORDER BY digest, unit) - 1 + 0.5::DOUBLE) / count(*) OVER (PARTITION BY mark) AS fraction
  FROM units
), big AS (
  SELECT *, row_number() OVER (ORDER BY bytes DESC, digest, unit) - 1 AS r FROM ranked WHERE is_big
), big_placed AS (
  SELECT *, (CASE WHEN r // 40 % 2 = 0 THEN r % 40 ELSE 39 - r % 40 END)::INTEGER AS shard FROM big
), small AS (
  SELECT *, (coalesce(sum(bytes) OVER (ORDER BY fraction, mark, digest, unit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             + bytes // 2)::BIGINT AS middle
  FROM ranked WHERE NOT is_big
), loads AS (
  SELECT s.shard::INTEGER AS shard, coalesce(sum(bytes), 0) AS load, (SELECT coalesce(sum(bytes), 0) FROM small) AS rest
  FROM range(40) s(shard) LEFT JOIN big_placed b ON b.shard = s.shard GROUP BY s.shard
), filled AS (
  SELECT *, ((rest + sum(load) OVER up + count(*) OVER up - 1) // count(*) OVER up) AS filled_to FROM loads
  WINDOW up AS (ORDER BY load, shard ROWS UNBOUNDED PRECEDING)
), room AS (
  SELECT shard, greatest(0, (SELECT min(filled_to) FROM filled) - load) AS room FROM filled
), line AS (
  SELECT shard, sum(room) OVER (ORDER BY shard) - room AS room_begin, sum(room) OVER (ORDER BY shard) AS room_end FROM room
), placed AS (
  SELECT unit, shard, fraction, mark, digest FROM big_placed
  UNION ALL
  SELECT unit, shard, fraction, mark, digest FROM small JOIN line ON middle >= room_begin AND middle < room_end
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY p.fraction, p.mark, p.digest, unit, i.digest, i.mark) - 1 AS slot,
       NULL::INTEGER AS grown_shard, source
FROM in_units i JOIN placed p USING (unit)
"""

OP3_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP4_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS nr, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT nr, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS nth FROM docs
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), common AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT nr) >= 10
), marked AS (
  SELECT keyed.*, common.key IS NULL AS stays FROM keyed LEFT JOIN common USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (stays), '')) AS kept_sha256
FROM marked GROUP BY nr, doc_id
"""

# Each source's stream is covered once per whole pass and once more up to the rest of its quota.
OP8_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('11:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))) AS digest
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0::DOUBLE, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source
), rates AS (
  SELECT s.*, (SELECT (sum(source_size) * 1.5::DOUBLE) FROM sources) AS wanted,
         coalesce((SELECT sum(2.0::DOUBLE * t.source_size) FROM sources t WHERE t.source_size / t.weight < s.source_size / s.weight), 0) AS stopped,
         (SELECT sum(t.weight) FROM sources t WHERE t.source_size / t.weight >= s.source_size / s.weight) AS open_weight
  FROM sources s
), rate AS (
  SELECT coalesce(arg_min((wanted - stopped) / open_weight, source_size / weight)
                    FILTER ((wanted - stopped) / open_weight <= 2.0::DOUBLE * source_size / weight), 1e300) AS rate
  FROM rates
), targets AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, rate * weight) AS target FROM sources, rate
), laid AS (
  SELECT sized.*, source_size, target, floor(target)::BIGINT AS quota,
         coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY digest, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE
         quota // source_size * size + greatest(0, least(start + size, quota % source_size) - start) END::BIGINT AS taken, source
FROM laid
"""

ORACLES = {"op1_sharding": OP1_SQL, "op3_exact_dedup": OP3_SQL, "op4_line_dedup": OP4_SQL, "op8_mixing": OP8_SQL}
