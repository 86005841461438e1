"""Lines that recur across documents, found by their hashes and returned as bitmaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import BLANKS, text_or_empty
from ledgerloom.session import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without ASCII blanks at its ends and with A-Z (no other letters) lower-cased."""
    bare = F.trim(line, F.lit(BLANKS))
    # lower() is much faster and does the same where all characters are ASCII
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def document_key() -> Column:
    """Names a row by its id and text, in 128 bits; rows equal in both share it, and lose the same lines."""
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.lit(":"), text_or_empty())
    return F.unhex(F.md5(named)).alias("doc_key")


def recurring_line_bitmaps(docs: DataFrame, min_docs: int = 10, min_length: int = 1) -> DataFrame:
    """Which lines of each document (doc_id, text) stay when lines found in min_docs documents go.

    Each line's key is hashed to 128 bits. Equal lines at one position of rows that are equal in id and text are summed to one
    row with their number. The hashes are range-partitioned with document and position as
    secondary sort, and each run is streamed: the first line of a (hash, document) run counts the rows of that document. A
    hash that a third of all documents share spans many ranges, as the document is part of the range. Runs are
    summed per hash, lines with a hash in enough documents are looked up again, and their positions are packed
    into bitmaps: one 64-bit word for 64 lines, of which only words with a dropped line are listed.

    Returns doc_id, doc_key and words (map from word number to its keep bits; the others keep all) for documents
    that lose a line. NULL ids are one id; every row is a document of its own, rows with equal id and text too. NULL and empty texts have one empty line, which is shorter than min_length and stays.
    """
    lines = docs.select("doc_id", document_key(), F.posexplode(F.split(text_or_empty(), "\n", -1)).alias("at", "line"))
    key = line_key(F.col("line"))
    hashed = lines.select("doc_key", "doc_id", "at", key.alias("key")).filter(F.char_length("key") >= min_length)
    hashed = hashed.select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"), "doc_key", "doc_id", "at"
    )
    hashed = staged(hashed, "line-hashes")
    places = hashed.groupBy("h1", "h2", "doc_key", "at").agg(F.count("*").alias("rows"))
    ranged = places.repartitionByRange("h1", "h2", "doc_key")
    run = Window.partitionBy("h1", "h2", "doc_key").orderBy("at")
    firsts = ranged.withColumn("nth", F.row_number().over(run)).filter("nth = 1")
    common = firsts.groupBy("h1", "h2").agg(F.sum("rows").alias("found_in")).filter(F.col("found_in") >= min_docs)
    common = staged(common, "line-common")
    dropped = hashed.join(common.select("h1", "h2"), ["h1", "h2"], "left_semi").select("doc_id", "doc_key", "at")
    bit = F.expr("shiftleft(1L, at % 64)")
    # one exchange by document serves both aggregations
    words = dropped.repartition("doc_key", "doc_id").groupBy("doc_id", "doc_key", F.expr("at div 64").alias("word"))
    words = words.agg(F.bitwise_not(F.bit_or(bit)).alias("keep"))
    return words.groupBy("doc_id", "doc_key").agg(F.map_from_entries(F.collect_list(F.struct("word", "keep"))).alias("words"))


def dense_words(lines: Column, words: Column) -> Column:
    """The bitmap with all its words, for access by number; NULL where no line goes."""
    last = F.floor((F.size(lines) - 1) / 64)
    full = F.transform(F.sequence(F.lit(0).cast("long"), last), lambda n: F.coalesce(words[n], F.lit(-1).cast("long")))
    return F.when(words.isNotNull(), full)


def apply_line_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Documents without their dropped lines: doc_id, n_lines, n_dropped, kept_text, one row per input row."""
    keep = bitmaps.select(F.col("doc_id").alias("_id"), F.col("doc_key").alias("_key"), "words")
    lined = docs.select("doc_id", document_key(), text_or_empty().alias("_text"))
    same = (F.col("doc_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    joined = lined.join(keep, same, "left").select("doc_id", F.split("_text", "\n", -1).alias("_lines"), "words")
    joined = joined.withColumn("_dense", dense_words(F.col("_lines"), F.col("words")))
    kept = F.expr("filter(_lines, (line, at) -> (shiftright(_dense[at div 64], at % 64) & 1) = 1)")
    kept = F.when(F.col("_dense").isNull(), F.col("_lines")).otherwise(kept)
    return joined.withColumn("_kept", kept).select(
        "doc_id",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size("_kept")).cast("long").alias("n_dropped"),
        F.array_join("_kept", "\n").alias("kept_text"),
    )
