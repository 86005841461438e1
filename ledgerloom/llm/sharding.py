"""Shards that all have the mixture of sources: proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import bucket_count, digest_bucket, text_or_empty, with_running_totals
from ledgerloom.session import staged

#: A unit above this part of a shard is placed by itself, before the interleaved ones; there are fewer than shards * BIG_PART.
BIG_PART = 64
RUN = 4096


def each_copy(rows: DataFrame, name: str) -> DataFrame:
    """A row for each of its copies, numbered from 0; runs of copies first, so that no row lists all of them."""
    runs = rows.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(RUN).cast("long"))))
    last = F.least(F.col("_from") + RUN, F.col("copies")) - 1
    return runs.withColumn(name, F.explode(F.sequence("_from", last))).drop("_from")


def dealing_units(light: DataFrame, total: int, shards: int, seed: int) -> DataFrame:
    """Rows with the unit that they are dealt in: unit, mark (of the source), digest, doc_id, source, size, text_crc32, copies.

    Equal texts are one unit, unless together they are larger than a shard's share; then each row is a unit. Rows equal in all
    columns are one row with their number, also in the second case until they have been counted.
    """
    rows = light.groupBy(*light.columns).agg(F.count("*").alias("copies"))
    rows = staged(rows.withColumn("mark", F.coalesce(F.concat(F.lit("1"), "source"), F.lit("0"))), "shard-rows")
    groups = rows.groupBy(F.col("text_hash").alias("_hash")).agg(F.sum(F.col("size") * F.col("copies")).alias("_bytes"))
    large = groups.filter(F.col("_bytes") * shards > total).select("_hash")  # fewer than `shards`
    of_large = F.col("text_hash") == F.col("_hash")
    whole = rows.join(F.broadcast(large), of_large, "left_anti").withColumn("nth", F.lit(0).cast("long"))
    single = each_copy(rows.join(F.broadcast(large), of_large, "left_semi"), "nth").withColumn("copies", F.lit(1).cast("long"))
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), doc, F.col("nth").cast("string"), "text_hash"))
    whole = whole.withColumn("digest", digest).withColumn("unit", F.col("text_hash"))
    single = single.withColumn("digest", digest).withColumn("unit", F.concat("text_hash", "digest", "mark"))
    return staged(whole.unionByName(single).drop("text_hash", "nth"), "shard-units")


def rooms(big: DataFrame, small_bytes: int, shards: int) -> DataFrame:
    """Which bytes of the interleaved units each shard takes beside its big units: shard, begin, end, cell.

    All shards are filled to one level (shards beyond it by big units alone take nothing). cell cuts the bytes into equal parts, so that
    a unit finds its shard by equality: at most 2 * shards rows.
    """
    numbers = big.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    loads = numbers.join(big.groupBy("shard").agg(F.sum("bytes").alias("load")), "shard", "left").fillna(0, "load")
    order = Window.orderBy("load", "shard").rowsBetween(Window.unboundedPreceding, 0)
    loads = loads.withColumn("_below", F.sum("load").over(order)).withColumn("_n", F.count("*").over(order))
    level = F.min(F.expr(f"({small_bytes}L + _below + _n - 1) div _n")).over(Window.partitionBy())
    loads = loads.withColumn("room", F.greatest(F.lit(0), level - F.col("load")))
    line = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    loads = loads.withColumn("end", F.sum("room").over(line)).withColumn("begin", F.col("end") - F.col("room"))
    taken = loads.filter("room > 0").filter(F.col("begin") < small_bytes)
    cells = F.sequence(F.expr(f"begin * {shards} div {max(small_bytes, 1)}"), F.expr(f"end * {shards} div {max(small_bytes, 1)}"))
    return taken.select("shard", "begin", "end", F.explode(cells).alias("cell"))


def interleaved_shards(docs: DataFrame, shards: int = 40, seed: int = 7) -> DataFrame:
    """Deal documents (doc_id, text, source) to shards of near equal bytes, each with its share of every source.

    Equal texts stay in one shard: they are one unit, which counts for the source of its first row. Only where equal texts are
    together larger than a shard's share are they dealt row by row. Units of a source are shuffled by a seeded
    digest and ranked; rank r of n gets the fraction (r - 1/2) / n. Sorted by fraction the sources are interleaved in proportion, so any
    contiguous cut has the mixture. The order is cut by bytes (law "bytes"). Units larger than a 64th of a shard would make
    the cuts uneven: they are dealt first, the largest ones forth and back over the shards, and the cut fills all shards to one level.
    Shards so differ by about a 64th of their size, unless a few units nearly as large as a shard leave no better choice.

    Returns one row per input row: doc_id, size (UTF-8 bytes + 16), text_crc32, law, shard, slot (from 0 without gaps, by fraction),
    grown_shard (NULL under this law), source. A NULL text counts as empty, and is equal to an empty one. NULL
    sources form one source. NULL and repeated ids are allowed: the shuffle is by id and text, and rows equal in all columns are
    interchangeable. No rows give no rows. Extra columns are ignored. Only row-sized digests are shuffled, never texts.
    """
    text = text_or_empty()
    light = docs.select(
        "doc_id",
        "source",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(text.cast("binary"), 256).alias("text_hash"),
    )
    light = staged(light, "shard-digests")
    count, total = light.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    buckets = bucket_count(count)
    rows = dealing_units(light, total, shards, seed)
    first = F.min(F.concat("digest", "mark"))
    units = rows.groupBy("unit").agg(F.sum(F.col("size") * F.col("copies")).alias("bytes"), F.sum("copies").alias("n"), first.alias("_first"))
    units = units.withColumn("digest", F.substring("_first", 1, 32)).withColumn("mark", F.expr("substring(_first, 33)")).drop("_first")
    units = staged(units.withColumn("bucket", digest_bucket(F.col("digest"), buckets)), "shard-ranks")
    of_source = units.groupBy("mark").agg(F.count("*").alias("of_source"))
    ranked = with_running_totals(units, ["mark"], "bucket", ["digest", "unit"], {"before": F.lit(1)}).join(of_source, "mark")
    ranked = ranked.withColumn("fraction", (F.col("before") + 0.5) / F.col("of_source")).drop("before", "of_source")
    ranked = staged(ranked.withColumn("bucket", F.floor(F.col("fraction") * buckets)), "shard-fractions")

    is_big = F.col("bytes") * (BIG_PART * shards) > total
    big = ranked.filter(is_big)
    place = F.row_number().over(Window.orderBy(F.desc("bytes"), "digest", "unit")) - 1  # fewer than BIG_PART * shards rows
    big = big.withColumn("_place", place).withColumn("shard", F.expr(f"if(_place div {shards} % 2 = 0, _place % {shards}, {shards - 1} - _place % {shards})"))
    big = staged(big.withColumn("shard", F.col("shard").cast("int")).drop("_place"), "shard-big")
    small = ranked.filter(~is_big)
    small_bytes = total - big.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    order = ["fraction", "mark", "digest", "unit"]
    small = with_running_totals(small, [], "bucket", order, {"before": F.col("bytes")})
    small = small.withColumn("_middle", F.col("before") + F.expr("bytes div 2"))
    small = small.withColumn("_cell", F.expr(f"_middle * {shards} div {max(small_bytes, 1)}"))
    near = rooms(big, small_bytes, shards)
    inside = (F.col("_cell") == F.col("cell")) & (F.col("_middle") >= F.col("begin")) & (F.col("_middle") < F.col("end"))
    placed = small.join(F.broadcast(near), inside).select(*big.columns).unionByName(big)
    placed = staged(placed, "shard-places")

    slots = with_running_totals(placed, ["shard"], "bucket", order, {"unit_slot": F.col("n")}).select("unit", "shard", "unit_slot")
    rows = rows.withColumn("bucket", digest_bucket(F.col("digest"), buckets))
    rows = with_running_totals(rows, ["unit"], "bucket", ["digest", "mark"], {"row_slot": F.col("copies")}).join(slots, "unit")
    return each_copy(rows, "copy").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("unit_slot") + F.col("row_slot") + F.col("copy")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )
