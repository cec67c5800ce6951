"""Documents as one row each, and reading them again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.geometry import PAGE
from ..operators.notes import ANNOTATIONS, annotations, resolve
from ..sources.tables import shared_folder
from ..operators.structure import FURNITURE, NOTE, VERSE, typed

SCHEMA_VERSION = "1.2"
#: What a document declares to have been looked for, whether or not it was found.
FEATURES = ["indent", "centered", "verse", "quote", "ref_label", "printer_key", "copyright", "list_item", "toc", "region", "running_head", "title_page", "dedication", "colophon", "epigraph", "citation_cues"]


def build(blk: DataFrame) -> DataFrame:
    """A row per document: doc_id, schema_version, features, blocks in order, footnotes by key."""
    # the notes are needed twice; they are resolved once
    path = shared_folder(blk.sparkSession, "notes")
    annotations(blk).write.parquet(path)
    found = blk.sparkSession.read.schema(ANNOTATIONS).parquet(path)
    b = typed(blk, notes=found.select(*PAGE, "block_idx", "note_type", "note_marker", "scope_key", "continuation"), compose=True)
    core = F.struct("id", "type", "text", F.col("page_idx").alias("page"), "level", "chapter", "region", T.find_refs(F.col("text")).alias("refs"), F.array(*[F.round(c, 1) for c in ("x0", "y0", "x1", "y1")]).alias("bbox"), F.when(F.col("type") == "table", F.when(F.col("html").isNotNull(), F.struct(F.lit("html").alias("format"), F.col("html").alias("content")))).alias("table"), "confidence", "needs_review", F.col("note_marker").alias("marker"), F.col("continuation"), "indent", "centered", "source")
    docs = b.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("page_idx", "seq", core.alias("b"), "scope_key", "continuation"))).alias("s"))
    docs = docs.select("doc_id", F.transform("s", lambda x: x["b"]).alias("blocks"), F.filter("s", lambda x: x["scope_key"].isNotNull() & ~x["continuation"]).alias("marked"))
    keep = ["marker", "kind", "text", "page", "chapter", "needs_review", "span_pages"]
    n = resolve(blk, found).groupBy("doc_id").agg(F.collect_list(F.struct("scope_key", *keep)).alias("notes"))
    # a note's block is the first that it is made of
    block = lambda key: F.get(F.filter("marked", lambda x: x["scope_key"] == key), F.lit(0))["b"]["id"]
    entry = lambda x: F.struct(x["scope_key"], F.struct(*[x[c].alias(c) for c in keep], block(x["scope_key"]).alias("block_id")))
    footnotes = F.map_from_entries(F.transform("notes", entry)).alias("footnotes")
    return docs.join(n, "doc_id", "left").select("doc_id", F.lit(SCHEMA_VERSION).alias("schema_version"), F.array(*map(F.lit, FEATURES)).alias("features"), "blocks", footnotes)


def to_json(docs: DataFrame) -> DataFrame:
    """The documents as JSON; keys without a value are written as null."""
    return docs.select("doc_id", F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"}).alias("json"))


def is_content(kind: Column) -> Column:
    """Whether a type is neither furniture nor a note; unknown types are content."""
    return ~F.coalesce(kind, F.lit("body")).isin(FURNITURE + NOTE)


def has_feature(b: DataFrame, name: str) -> Column:
    """Whether a row's document declares the feature; rows without a column features come from this version, which has all of FEATURES."""
    return F.coalesce(F.array_contains("features", name), F.lit(False)) if "features" in b.columns else F.lit(name in FEATURES)


def iter_blocks(b: DataFrame, region: str | None = None, types: Sequence[str] | None = None, exclude_types: Sequence[str] | None = None, chapter: str | None = None) -> DataFrame:
    """Blocks for which all that is asked for holds; a block without a region is of the body. They are ordered by page and seq."""
    out = b
    if region is not None:
        out = out.filter(F.coalesce("region", F.lit("body")) == region)
    if types is not None:
        out = out.filter(F.col("type").isin(list(types)))
    if exclude_types is not None:
        out = out.filter(~F.coalesce(F.col("type").isin(list(exclude_types)), F.lit(False)))
    return out if chapter is None else out.filter(F.col("chapter") == chapter)


def headings(b: DataFrame) -> DataFrame:
    return iter_blocks(b, types=["heading"])


def doc_lengths(b: DataFrame) -> DataFrame:
    """How many blocks each document has."""
    return b.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_blocks"))


#: What is read of a document in JSON; other keys are left alone.
BLOCK_DDL = "id string, type string, text string, page long, level int, chapter string, region string, marker string, continuation boolean"
DOC_DDL = f"doc_id string, schema_version string, title string, source string, features array<string>, blocks array<struct<{', '.join(x.replace(' ', ':', 1) for x in BLOCK_DDL.split(', '))}>>"


def open_docs(texts: DataFrame, column: str = "json") -> DataFrame:
    """The blocks of documents in JSON, a row each: doc_id, schema_version ('0' where there is none), features, seq and the block's fields.

    Texts that aren't JSON give no rows; a block without a region is of the body.
    """
    d = texts.select(F.from_json(column, DOC_DDL).alias("d")).filter("d.blocks IS NOT NULL").select("d.*")
    d = d.select("doc_id", F.coalesce("schema_version", F.lit("0")).alias("schema_version"), F.coalesce("features", F.array().cast("array<string>")).alias("features"), F.posexplode("blocks").alias("seq", "b"))
    return d.select("doc_id", "schema_version", "features", "seq", "b.*").withColumn("region", F.coalesce("region", F.lit("body"))).withColumn("page_idx", F.col("page"))


def content_blocks(b: DataFrame, region: str | None = "body") -> DataFrame:
    """Blocks that are neither furniture nor notes; of the region, where the document declares regions."""
    out = b.filter(is_content(F.col("type")))
    return out if region is None else out.filter(~has_feature(b, "region") | (F.coalesce("region", F.lit("body")) == region))


def doc_text(b: DataFrame, region: str | None = "body", sep: str = "\n\n") -> DataFrame:
    """Each document's content as one text."""
    s = F.sort_array(F.collect_list(F.struct("page_idx", "seq", "text")))
    return content_blocks(b, region).groupBy("doc_id").agg(F.array_join(F.transform(s, lambda x: x["text"]), sep).alias("text"))


def type_counts(b: DataFrame) -> DataFrame:
    return b.groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def verses_of(b: DataFrame) -> DataFrame:
    return b.filter(F.col("type").isin(VERSE))


def page_text(blk: DataFrame, drop: tuple[str, ...] = ("PageHeader", "PageFooter")) -> DataFrame:
    """Text of each page in reading order, without the labels in drop."""
    from ..operators.geometry import PAGE, reading_order

    b = reading_order(blk).filter(~F.col("label").isin(*drop))
    s = F.sort_array(F.collect_list(F.struct("seq", T.emit(T.normalize(F.col("text"), compose=False), True, True).alias("text"))))
    return b.groupBy(*PAGE).agg(F.array_join(F.transform(s, lambda x: x["text"]), "\n\n").alias("page_text"), F.count(F.lit(1)).alias("n_blocks"))
