"""Geometry of page blocks: columns, reading order, overlaps, layout labels, line boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAGE = ["doc_id", "page_idx"]


def with_columns(blk: DataFrame, only: Column | None = None, name: str = "col") -> DataFrame:
    """A column number, left to right, for the blocks that `only` selects (all if not given); null for others.

    Blocks of a page are swept by x0; a gutter is where a block begins beyond the running maximum of x1. A block that spans
    the page joins all columns into one.
    """
    use = F.coalesce(only, F.lit(False)) if only is not None else F.lit(True)
    w = Window.partitionBy(*PAGE, "use_").orderBy("x0", "x1", "block_idx")
    reach = F.max("x1").over(w.rowsBetween(Window.unboundedPreceding, -1))
    out = blk.withColumn("use_", use).withColumn("new_", (reach.isNotNull() & (F.col("x0") > reach)).cast("int"))
    out = out.withColumn(name, F.sum("new_").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return out.withColumn(name, F.when(F.col("use_"), F.col(name))).drop("use_", "new_")


def reading_order(blk: DataFrame) -> DataFrame:
    """blk with col and seq, from 1: down each column in turn, then footnotes; columns are those of the other blocks."""
    foot = F.coalesce(F.col("label") == "Footnote", F.lit(False))
    out = with_columns(blk, ~foot)
    w = Window.partitionBy(*PAGE).orderBy(foot.cast("int"), F.coalesce("col", F.lit(0)), "y0", "block_idx")
    return out.withColumn("seq", F.row_number().over(w))


def with_overlaps(blk: DataFrame) -> DataFrame:
    """blk with overlaps: whether the box intersects another block's of its page, whose boxes, a few dozen, lie in an array beside it."""
    boxes = F.collect_list(F.struct("block_idx", "x0", "y0", "x1", "y1")).over(Window.partitionBy(*PAGE))
    other = lambda o: (o["block_idx"] != F.col("block_idx")) & (o["x0"] < F.col("x1")) & (F.col("x0") < o["x1"]) & (o["y0"] < F.col("y1")) & (F.col("y0") < o["y1"])
    return blk.withColumn("boxes_", boxes).withColumn("overlaps", F.exists("boxes_", other)).drop("boxes_")


def overlapping(blk: DataFrame) -> DataFrame:
    """The blocks whose boxes intersect another block's of their page."""
    return with_overlaps(blk).filter("overlaps").drop("overlaps")


def merge_layout(blk: DataFrame, regions: DataFrame, least: float = 0.5) -> DataFrame:
    """blk with new_label: of the region that covers more than `least` of a block most, the first of equals; else Text. Pictures stay."""
    r = regions.select(*PAGE, "region_idx", F.col("label").alias("region_label"), *[F.col(c).alias("r" + c) for c in ("x0", "y0", "x1", "y1")])
    b = blk.join(r, PAGE, "left")
    wide = F.greatest(F.least("x1", "rx1") - F.greatest("x0", "rx0"), F.lit(0.0))
    high = F.greatest(F.least("y1", "ry1") - F.greatest("y0", "ry0"), F.lit(0.0))
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    cover = F.when(area > 0, wide * high / area).otherwise(F.lit(0.0))
    best = b.withColumn("cover", cover).filter(F.col("cover") > least).groupBy(*PAGE, "block_idx").agg(F.min_by("region_label", F.struct(-F.col("cover"), F.col("region_idx"))).alias("found"))
    out = blk.join(best, [*PAGE, "block_idx"], "left")
    return out.withColumn("new_label", F.when(F.col("label") == "Picture", F.col("label")).otherwise(F.coalesce("found", F.lit("Text")))).drop("found")


def line_boxes(blk: DataFrame, det: DataFrame, near: float = 2.0) -> DataFrame:
    """blk with boxes: the detected lines whose centre lies in the block, top down, if they are as many as its non-blank lines."""
    d = det.select(*PAGE, F.struct(*[F.round(F.col(c), 1).alias(c) for c in ("y0", "x0", "x1", "y1")]).alias("box"), ((F.col("x0") + F.col("x1")) / 2).alias("cx"), ((F.col("y0") + F.col("y1")) / 2).alias("cy"))
    inside = F.col("cx").between(F.col("x0") - near, F.col("x1") + near) & F.col("cy").between(F.col("y0") - near, F.col("y1") + near)
    found = blk.join(d, PAGE).filter(inside).groupBy(*PAGE, "block_idx").agg(F.sort_array(F.collect_list("box")).alias("boxes"))
    out = blk.join(found, [*PAGE, "block_idx"], "left")
    n = F.size(F.filter(F.split("text", "\n"), lambda x: x.rlike(r"\S")))
    return out.withColumn("boxes", F.when(F.size("boxes") == n, F.col("boxes")))


def line_items(blk: DataFrame) -> DataFrame:
    """A row per non-blank line with its box: the detected one where there is one per line, else an equal band of the block."""
    out = blk.withColumn("l_", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"\S"))).filter(F.size("l_") > 0)
    out = out.select("*", F.posexplode("l_").alias("line", "line_text"))
    step = (F.col("y1") - F.col("y0")) / F.size("l_")
    band = lambda k: F.col("y0") + step * (F.col("line") + k)
    box = lambda f, other: F.coalesce(F.get("boxes", "line")[f], other)
    return out.select(*PAGE, "block_idx", "line", "line_text", box("x0", F.col("x0")).alias("lx0"), box("y0", band(0)).alias("ly0"), box("x1", F.col("x1")).alias("lx1"), box("y1", band(1)).alias("ly1"))


def recombine(strips: DataFrame, mapping: DataFrame) -> DataFrame:
    """Blocks of strips as blocks of their page: shifted right by the strip's offset, numbered by strip, in one sequence."""
    out = strips.join(mapping, "stem")
    w = Window.partitionBy("page").orderBy("strip", "x_off", "block_idx")
    return out.select("page", (F.row_number().over(w) - 1).alias("new_idx"), (F.col("x0") + F.col("x_off")).alias("x0"), "y0", (F.col("x1") + F.col("x_off")).alias("x1"), "y1", "text")


def uniform_box(pages: DataFrame) -> DataFrame:
    """Each page's scale and offsets in a box as large as the largest width and height of the document."""
    w = Window.partitionBy("doc_id")
    big_w, big_h = F.max("w").over(w), F.max("h").over(w)
    scale = F.least(big_w / F.col("w"), big_h / F.col("h"))
    return pages.select("doc_id", "page_idx", scale.alias("scale"), ((big_w - F.col("w") * scale) / 2).alias("dx"), ((big_h - F.col("h") * scale) / 2).alias("dy"))
