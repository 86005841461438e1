"""Exact duplicates by content-defined chunk recipes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import text_or_empty
from ledgerloom.session import staged

#: A chunk ends after a line break, or after white space between a sentence end and one of these capitals.
CHUNK_END = r"\n|(?<=[.!?])\s(?=[A-F])"
SHORTEST, LONGEST = 64, 8192


def chunk_list(text: Column, shortest: int = SHORTEST, longest: int = LONGEST) -> Column:
    """The text cut where its own content says so; joined again the chunks give the text."""
    pattern = rf"(?s).{{{shortest},{longest - 1}}}?(?:{CHUNK_END})|.{{1,{longest}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def chunk_id(chunk: Column, id_bits: int) -> Column:
    return F.xxhash64(chunk) if id_bits == 64 else F.shiftrightunsigned(F.xxhash64(chunk), 64 - id_bits)


def chunk_variants(docs: DataFrame, id_bits: int = 64) -> DataFrame:
    """Chunks whose identifier another chunk has too: chunk_key, chunk, variant (1, 2, ...; 0 is not listed).

    Every distinct chunk of the corpus moves once, to be compared with those of the same identifier. The
    result is empty unless identifiers clash.
    """
    text = text_or_empty()
    chunks = docs.select(F.explode(chunk_list(text)).alias("chunk")).withColumn(
        "chunk_key", chunk_id(F.col("chunk"), id_bits)
    )
    distinct = chunks.distinct()
    clashing = distinct.groupBy("chunk_key").agg(F.count("*").alias("texts")).filter("texts > 1").select("chunk_key")
    clashing = staged(clashing, "chunk-clashes")
    order = Window.partitionBy("chunk_key").orderBy("chunk")
    if clashing.isEmpty():
        return clashing.select("chunk_key", F.lit("").alias("chunk"), F.lit(0).alias("variant"))
    numbered = chunks.join(clashing, "chunk_key", "left_semi").distinct().withColumn(
        "variant", F.row_number().over(order) - 1
    )
    return staged(numbered.filter("variant > 0"), "chunk-variants")


def exact_dedup(docs: DataFrame, id_bits: int = 64) -> DataFrame:
    """Documents (doc_id, text) with equal texts; the largest doc_id of each group stays.

    Each text is cut into content-defined chunks; a chunk's identifier is its 64-bit hash, verified by comparing
    all distinct chunks of one hash: a chunk that clashes gets a variant number besides. A document is then the
    ordered list of its identifiers, its recipe, and equal recipes are equal texts. Grouping and the join that
    brings the decision back move recipes (8 bytes for each chunk of some hundred characters), not texts, and
    the aggregation is partial before its shuffle, so a text that a third of all rows share is one row per task.

    Returns one row per input row: doc_id, keep_id, group_size, kept, text_sha256. A NULL text counts as empty;
    empty texts are equal. A missing doc_id is smaller than any other; where all ids of a group are missing,
    keep_id is NULL and its rows stay. Repeated rows (same id, same text) count each in group_size, and stay or go
    together. No rows give no rows. Extra columns are ignored. id_bits below 64 is for tests: it makes clashes.
    """
    text = text_or_empty()
    recipes = staged(
        docs.select(
            "doc_id",
            F.transform(chunk_list(text), lambda chunk: chunk_id(chunk, id_bits)).alias("recipe"),
            F.sha2(text, 256).alias("text_sha256"),
        ),
        "chunk-recipes",
    )
    variants = chunk_variants(docs, id_bits)
    if variants.isEmpty():
        recipes = recipes.withColumn("variants", F.array().cast("array<struct<at:int,variant:int>>"))
    else:
        at = docs.select(F.sha2(text, 256).alias("_sha"), text.alias("_text")).distinct()
        at = at.select("_sha", F.posexplode(chunk_list(F.col("_text"))).alias("at", "chunk"))
        at = at.withColumn("chunk_key", chunk_id(F.col("chunk"), id_bits)).join(variants, ["chunk_key", "chunk"])
        fixes = at.groupBy("_sha").agg(F.sort_array(F.collect_list(F.struct("at", "variant"))).alias("variants"))
        recipes = recipes.join(fixes, recipes["text_sha256"] == fixes["_sha"], "left").drop("_sha")
        none = F.array().cast("array<struct<at:int,variant:int>>")
        recipes = recipes.withColumn("variants", F.coalesce("variants", none))
    groups = recipes.groupBy(F.col("recipe").alias("_recipe"), F.col("variants").alias("_variants")).agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    same = (F.col("recipe") == F.col("_recipe")) & (F.col("variants") == F.col("_variants"))
    return recipes.join(groups, same).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
