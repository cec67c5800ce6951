"""Exact deduplication (10): two-pass Bloom filtering; DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, dealt_join, table

#: Bits of the filter for each row, and the most bits of each of its two halves: the broadcast never grows beyond 128 MB.
BITS_A_ROW, MOST_BITS = 16, 1 << 28
#: Bits in one row of the broadcast table, as bitmap_construct_agg fixes them.
PAGE = 32768


def bitmaps(rows: DataFrame, place: Column) -> DataFrame:
    """(page, words): the bits at the places of rows, PAGE bits a row, 32 of them in each of the numbers.

    As numbers in an array, unlike bytes, they are read from a joined row without copying it.
    """
    maps = rows.groupBy((place / PAGE).cast("long").alias("page")).agg(F.bitmap_construct_agg(place % PAGE).alias("bitmap"))
    word = lambda i: F.conv(F.hex(F.substring("bitmap", i * 4 + 1, F.lit(4))), 16, 10).cast("long")
    return maps.select("page", F.transform(F.sequence(F.lit(0), F.lit(PAGE // 32 - 1)), word).alias("words"))


def bit(words: Column, position: Column) -> Column:
    """Whether the bit at a position of a page is set; false where there is no page."""
    at = F.lit(24) - (position % 32 / 8).cast("int") * 8 + (position % 8).cast("int")
    return F.coalesce(F.getbit(F.get(words, (position / 32).cast("int")), at) == 1, F.lit(False))


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", most_bits: int = MOST_BITS, sent: int | None = None) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after each run of white space became one space; null counts as empty.
    The first pass counts, at two hashed places per text, whether more than one row falls there; the places hit
    repeatedly make two bitmaps. In the second pass only rows with both bits set may have a copy: they alone are
    grouped by the hash of the text, and the rest pass straight through as their own groups. If the input outgrows
    the bitmaps, more rows are shuffled; the result stays the same.
    Rows repeated with the same doc_id count as copies, and just one of them stays. A null doc_id is the smallest.
    An empty table gives no rows; other columns aren't read.
    """
    spark = docs.sparkSession
    norm = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE, " ")
    rows = table(docs.select(F.col(doc_id).alias("doc_id"), F.unhex(F.sha2(norm, 256)).alias("sha"), F.monotonically_increasing_id().alias("row")), "exact")
    bits = min(most_bits, max(PAGE, 1 << math.ceil(math.log2(max(1, rows.count()) * BITS_A_ROW))))
    places = [F.pmod(F.xxhash64("sha", F.lit(i)), F.lit(bits)) + i * bits for i in (0, 1)]
    repeated = rows.select(F.explode(F.array(*places)).alias("place")).groupBy("place").count().filter("count > 1")
    maps = table(bitmaps(repeated, F.col("place")), "bloom")
    seen = rows.withColumns({"p0": places[0], "p1": places[1]})
    for i in (0, 1):
        half = F.broadcast(maps.select(F.col("page").alias(f"page{i}"), F.col("words").alias(f"words{i}")))
        seen = seen.join(half, (F.col(f"p{i}") / PAGE).cast("long") == F.col(f"page{i}"), "left")
    seen = seen.select("doc_id", "sha", "row", (bit(F.col("words0"), F.col("p0") % PAGE) & bit(F.col("words1"), F.col("p1") % PAGE)).alias("maybe"))
    out = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    hexed = F.lower(F.hex("sha")).alias("text_sha256")
    alone = seen.filter("not maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), hexed)
    maybe = seen.filter("maybe").drop("maybe")
    # a group's rows needn't be together: they are joined with its one row where they are, or spread if there are too many groups to send
    groups = maybe.groupBy("sha").agg(F.min(F.struct("doc_id", "row")).alias("first"), F.count(F.lit(1)).alias("group_size"))
    some = dealt_join(maybe, table(groups, "groups"), ["sha"], "group_size", sent=sent)
    some = some.select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"), hexed)
    return alone.select(out).unionByName(some.select(out))


def op10_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""
