"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import WORD, bucket_count, digest_bucket, seeded_digest, with_running_totals
from ledgerloom.session import staged


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Target words per source: shares by weight, none above `most` times its size, the excess reshared by weight.

    sizes has source, source_size. Sources in code-point order, NULL last, take the weights in turn. With the
    sources sorted by most * size / weight, those up to some place stop at their limit and the others get one rate per
    weight; the rate is the first that no later source's limit cuts. The table has one row per source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    limit = F.col("source_size") * float(most)
    table = sizes.withColumn("place", place).withColumn("weight", weight).withColumn("limit", limit)
    total = Window.partitionBy()
    order = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    stopped = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    table = table.withColumn("wanted", F.sum("source_size").over(total) * float(share))
    table = table.withColumn("rate", (F.col("wanted") - stopped) / open_weight)
    fits = F.col("rate") <= F.col("limit") / F.col("weight")
    table = table.withColumn("rate", F.min(F.when(fits, F.struct(F.col("limit") / F.col("weight"), "place", "rate"))).over(total)["rate"])
    target = F.least(F.col("limit"), F.coalesce(F.col("rate") * F.col("weight"), F.col("limit")))
    return table.select("source", "place", "source_size", target.alias("target"))


def mix_schedule(targets: DataFrame, block_words: int) -> DataFrame:
    """Slots of the mix: place (of the source), turn, slot_rank, epoch, block, words.

    A source's quota is its target in whole words; it needs a slot for each block of each pass over the source, the last
    one as long as what is left. Slot counts are laid end to end as cumulative weights over the points of a van der
    Corput sequence of 2^k points: point v / 2^k falls to the source whose interval holds it, and it comes at turn
    reverse-of-bits(v). Each source so gets exactly its slots, spread evenly over the turns. Slots are ranked by turn
    within their source; rank r reads block r mod (blocks of the source).
    """
    quotas = targets.withColumn("quota", F.floor("target"))
    quotas = quotas.withColumn("blocks", F.ceil(F.col("source_size") / block_words)).filter("quota > 0")
    passes, rest = F.expr("quota div source_size"), F.expr("quota % source_size")
    quotas = quotas.withColumn("slots", passes * F.col("blocks") + F.ceil(rest / block_words))
    quotas = quotas.withColumn("to", F.sum("slots").over(Window.orderBy("place")))
    quotas = staged(quotas.withColumn("from", F.col("to") - F.col("slots")), "mix-quotas")
    points = quotas.agg(F.coalesce(F.max("to"), F.lit(0))).first()[0]
    bits = max(1, int(points).bit_length())
    buckets = min(bucket_count(points), 1 << bits)
    # whole runs of points first, so that no row lists all points of a large source
    run = 4096
    runs = quotas.select("*", F.explode(F.sequence(F.col("from"), F.col("to") - 1, F.lit(run).cast("long"))).alias("first"))
    runs = runs.repartition("place", "first")
    each = runs.select("*", F.explode(F.sequence(F.col("first"), F.least(F.col("first") + run, F.col("to")) - 1)).alias("point"))
    turn = F.conv(F.reverse(F.lpad(F.bin("point"), bits, "0")), 2, 10).cast("long")
    slots = each.select("place", "blocks", "source_size", "quota", turn.alias("turn"))
    slots = slots.withColumn("bucket", F.shiftright("turn", bits - (buckets.bit_length() - 1)))
    slots = with_running_totals(slots, ["place"], "bucket", ["turn"], {"slot_rank": F.lit(1)})
    slots = slots.withColumn("epoch", F.expr("slot_rank div blocks")).withColumn("block", F.expr("slot_rank % blocks"))
    begin = F.col("block") * block_words
    words = F.least(F.lit(block_words), F.col("source_size") - begin, F.col("quota") - F.col("epoch") * F.col("source_size") - begin)
    return slots.select("place", "turn", "slot_rank", "epoch", "block", words.alias("words"))


def mix_sources(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 11,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """How many words the mix takes of each document (doc_id, text, source), repeats counted.

    Documents of a source are shuffled by a seeded digest and laid end to end; the stream is cut into blocks of
    equal words, about two for a document of mean size, and the schedule of mix_schedule says which block comes next.
    Joining slots to blocks gives each document the words that its blocks bring.

    Returns one row per input row: doc_id, size (words), source_size, target, taken, source, and the carried columns. A source's taken words are its
    target rounded down; at most `most` passes are made, so no document is taken more often. A NULL text has no words; a
    document without words is taken 0 times. NULL sources are one source, the last. NULL and repeated ids are
    allowed: the shuffle is by id and text, so rows of one id lie apart; rows equal in both are neighbours, ordered by what is carried. Empty tables give no rows; sources without words
    have target 0. Extra columns are ignored. The shuffle is by rank in digest ranges, so a source with a third of all
    rows is spread over all tasks.
    """
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    light = docs.select("doc_id", "source", words.alias("size"), seeded_digest("doc_id", seed, "text").alias("digest"), *carry)
    light = staged(light, "mix-sizes")
    rows, total = light.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    block_words = max(1, total // max(1, 2 * rows))
    targets = staged(source_targets(light.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "mix-targets")
    known = targets.select(F.col("source").alias("_source"), "place", "source_size", "target")
    named = light.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    named = named.withColumn("bucket", digest_bucket(F.col("digest"), bucket_count(rows)))
    laid = with_running_totals(
        named, ["place"], "bucket", ["digest", "doc_id", "size", *carry], {"nth": F.lit(1), "begin": F.col("size")}
    )
    laid = staged(laid.drop("bucket", "digest"), "mix-streams")
    end = F.col("begin") + F.col("size")
    numbers = F.sequence(F.expr(f"begin div {block_words}"), F.expr(f"(begin + size - 1) div {block_words}"))
    pieces = laid.filter("size > 0").select("place", "nth", "begin", end.alias("end"), F.explode(numbers).alias("block"))
    slots = mix_schedule(targets, block_words).select(F.col("place").alias("_place"), F.col("block").alias("_block"), "words")
    # never broadcast: the slots come out of explode(), whose size Spark takes for that of the table of sources
    met = pieces.join(slots.hint("merge"), (F.col("place") == F.col("_place")) & (F.col("block") == F.col("_block")))
    start = F.col("block") * block_words
    overlap = F.greatest(F.lit(0), F.least(F.col("end"), start + F.col("words")) - F.greatest(F.col("begin"), start))
    taken = met.groupBy("place", "nth").agg(F.sum(overlap).alias("taken"))
    return laid.join(taken, ["place", "nth"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source", *carry
    )
