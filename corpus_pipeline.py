"""From raw documents to token ids: quality filter, exact and near dedup, mixing, byte-level BPE."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.chunk_dedup import exact_dedup
from ledgerloom.llm.common import documents, text_or_empty
from ledgerloom.llm.pairwise_quality import quality_scores
from ledgerloom.llm.queries import byte_bpe_digests
from ledgerloom.llm.simhash_grid import rooted_fingerprints
from ledgerloom.llm.source_schedule import mix_sources
from ledgerloom.session import staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def row_key(sha256: Column) -> Column:
    """A row's id and the digest of its text in one; a missing id is told from every other, and the key is never NULL."""
    return F.concat(F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("none")), F.lit(":"), sha256)


def keyed(docs: DataFrame) -> DataFrame:
    """The documents with _key, equal for rows of equal id and text; a NULL text counts as empty, as in every stage."""
    return docs.select(*COLUMNS, row_key(F.sha2(text_or_empty(), 256)).alias("_key"))


def of_keys(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """One document for each listed _key: rows of equal id and text become one, with the smallest lang, source and n_chars.

    Equal rows are merged by partial aggregation before the shuffle, so a row that fills a third of the table is one row
    per task; the join then finds the rows dealt by the same key, and each text moves once.
    """
    least = F.min(F.struct("lang", "source", "n_chars"))
    merged = keyed(docs).groupBy("_key").agg(F.first("doc_id").alias("doc_id"), F.max("text").alias("text"), least.alias("rest"))
    found = merged.join(keys.select(F.col("_key").alias("_kept")), F.col("_key") == F.col("_kept"), "left_semi")
    return found.select("doc_id", "text", "rest.*").select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the pairwise quality model scores below 0.3."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_scores(docs, labels, threshold=0.3, carry=COLUMNS).filter("predicted = 1").select(*COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of equal texts, one with the largest doc_id; without any id in the group, one without."""
    return of_keys(docs, exact_dedup(docs).filter("kept").select(row_key(F.col("text_sha256")).alias("_key")))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of linked SimHash fingerprints, one with the smallest doc_id.

    Missing ids come last; where rows of one id differ, the smallest digest of the text decides.
    """
    rooted = rooted_fingerprints(keyed(docs), words=4, seed=42, max_bits=4, carry=("_key",))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_key"))
    return of_keys(docs, rooted.groupBy("root").agg(first.alias("first")).select("first._key"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out whole documents: as often as the mix takes their words, rounded to a whole number.

    In each source all documents are taken equally often but those after the place where its quota ends, which are taken
    once less; only the one at that place is rounded. Rows of equal id, text and source, which the stages before leave no
    two of, are taken equally often.
    """
    docs = keyed(docs).withColumn("_key", F.concat(F.coalesce(F.concat(F.lit("="), "source"), F.lit("none")), F.lit(":"), "_key"))
    mixed = mix_sources(docs, weights=(5, 2, 1), share=1.5, most=2.0, seed=11, carry=("_key",))
    copies = mixed.filter("size > 0").groupBy("_key").agg(F.round(F.sum("taken") / F.sum("size")).cast("int").alias("copies"))
    copies = copies.filter("copies > 0").select(F.col("_key").alias("_taken"), "copies")
    found = docs.join(copies, F.col("_key") == F.col("_taken"))
    return found.withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of byte-level BPE tokens and digests of ids and decoded bytes, one row per document of the mix."""
    return byte_bpe_digests(docs)


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixing), ("byte_bpe", tokens)]

#: The learned quality model, SimHash and the tokenizer cannot be written in SQL; tests hold the result against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
