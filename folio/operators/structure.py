"""Structure of documents: running heads, verses, regions, block types, chapters, review flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .geometry import PAGE, reading_order, with_columns, with_overlaps

#: Engine labels and the types they stand for (fixed values); others are body.
TYPES = {
    "heading": ["Title", "SectionHeader", "Section-header"],
    "page_header": ["PageHeader", "Page-header"],
    "page_footer": ["PageFooter", "Page-footer"],
    "page_number": ["PageNumber", "Page-number"],
    "footnote": ["Footnote"],
    "caption": ["Caption"],
    "list_item": ["ListItem", "List-item", "ListGroup"],
    "table": ["Table"],
    "figure": ["Figure", "Picture"],
    "toc": ["TableOfContents"],
}
FURNITURE = ["page_header", "page_footer", "page_number", "running_head", "title_page", "copyright", "colophon", "dedication", "toc"]
VERSE, NOTE = ["verse", "quote", "epigraph"], ["footnote", "endnote"]


def label_type(label):
    out = F.lit("body")
    for kind, labels in TYPES.items():
        out = F.when(label.isin(labels), kind).otherwise(out)
    return out


def with_running_heads(blk: DataFrame, least: int = 3) -> DataFrame:
    """blk with head_type, for blocks at the top or bottom whose text, but for numbers, stands on several pages."""
    cy = (F.col("y0") + F.col("y1")) / 2
    band = F.when(cy < 0.1 * F.col("page_h"), "top").when(cy > 0.9 * F.col("page_h"), "bottom")
    mask = F.substring(T.strip(F.regexp_replace("text", r"\d+", "#")), 1, 80)
    b = blk.withColumn("band", band).withColumn("mask", F.when(F.col("band").isNotNull(), F.nullif(mask, F.lit(""))))
    pages = F.size(F.collect_set("page_idx").over(Window.partitionBy("doc_id", "band", "mask")))
    b = b.withColumn("often", F.col("mask").isNotNull() & (pages >= least))
    kind = F.when(T.strip(F.col("text")).rlike(r"^\d+$"), "page_number").when(F.col("band") == "top", "page_header").otherwise("page_footer")
    return b.withColumn("head_type", F.when(F.col("often"), kind)).drop("band", "mask", "often")


def running_heads(blk: DataFrame, least: int = 3) -> DataFrame:
    return with_running_heads(blk, least).filter("head_type IS NOT NULL")


def verses(blk: DataFrame) -> DataFrame:
    """blk with col2, ml, mr (the column's median margins), indent, centered and verse_type: verse, quote or null."""
    out = with_columns(blk, name="col2")
    textish = ~F.coalesce(F.col("label"), F.lit("")).isin("PageHeader", "PageFooter", "Table", "Figure", "Picture") & (F.col("x1") > F.col("x0"))
    out = out.withColumn("textish", textish)
    column = Window.partitionBy(*PAGE, "col2")
    side = lambda c: F.median(F.when(F.col("textish"), F.col(c))).over(column)
    out = out.withColumns({"ml": side("x0"), "mr": side("x1"), "n_text": F.count_if("textish").over(column)})
    known = (F.col("n_text") >= 2) & (F.col("mr") > F.col("ml"))
    out = out.withColumns({c: F.when(known, F.col(c)) for c in ("ml", "mr", "n_text")})
    w = F.col("mr") - F.col("ml")
    left, right = (F.col("x0") - F.col("ml")) / w, (F.col("mr") - F.col("x1")) / w
    centered = (left >= 0.06) & (right >= 0.06) & (F.abs((F.col("x0") + F.col("x1") - F.col("ml") - F.col("mr")) / 2 / w) <= 0.07)
    candidate = F.col("textish") & w.isNotNull() & (F.col("label").isNull() | (F.col("label") == "Text"))
    out = out.withColumns({"indent": F.when(candidate, F.round(F.greatest(F.lit(0.0), left), 3)), "centered": F.when(candidate, centered)})
    n = F.size(T.lines(F.col("text")))
    kind = F.when(candidate & (n >= 2) & ((F.greatest(F.lit(0.0), left) >= 0.035) | centered), F.when(T.is_flowed(F.col("text")), "quote").otherwise("verse"))
    return out.withColumn("verse_type", kind)


def signs(blk: DataFrame) -> DataFrame:
    """blk with head_type, indent, centered and sign: what its shape says it is.

    A running head, else a copyright line or printer's key, else a verse or quote, a list item, a line of contents; null
    if none.
    """
    t = F.col("text")
    b = with_running_heads(verses(blk))
    sign = (
        F.when(F.col("head_type").isNotNull(), F.col("head_type"))
        .when(T.is_printer_key(t) | T.is_copyright(t), "copyright")
        .when(F.col("verse_type").isNotNull(), F.col("verse_type"))
        .when(T.is_list_item(t), "list_item")
        .when(T.is_toc(t), "toc")
    )
    return b.withColumn("sign", sign)


def signals() -> dict:
    """Aggregates of signs() over a page: has it copyright, contents, back matter; its prose blocks and blocks."""
    t, heading = F.col("text"), F.col("label").isin("SectionHeader", "Title")
    prose = (F.col("label").isNull() | (F.col("label") == "Text")) & (F.length("text") > 80)
    sign = F.coalesce("sign", F.lit(""))
    contents = (sign == "toc") | (heading & t.rlike("(?i)" + T.CONTENTS))
    back = heading & t.rlike("(?i)" + T.BACK_MATTER)
    some = lambda c: F.max(F.coalesce(c, F.lit(False)))
    return {"copyright": some(sign == "copyright"), "toc": some(contents), "prose": F.count_if(prose), "back": some(back), "n_blocks": F.count(F.lit(1))}


def page_signals(signed: DataFrame) -> DataFrame:
    """signals() per page."""
    return signed.groupBy(*PAGE).agg(*[c.alias(k) for k, c in signals().items()])


def regions(pages: DataFrame) -> DataFrame:
    """pages with signals, or blocks with those of their page, with region: front, body or back; documents of up to two pages are body."""
    w = Window.partitionBy("doc_id")
    front = F.col("copyright") | F.col("toc") | (F.col("prose") == 0)
    n = F.max("page_idx").over(w) + 1
    s = pages.withColumns({"n_": n, "end_": F.least(F.coalesce(F.min(F.when(~front, F.col("page_idx"))).over(w), n), F.greatest(F.lit(8), F.floor(n * 0.25)))})
    s = s.withColumn("back_", F.min(F.when(F.col("back") & (F.col("page_idx") >= F.greatest(F.col("end_"), F.floor(F.col("n_") / 2))), F.col("page_idx"))).over(w))
    region = F.when(F.col("n_") <= 2, "body").when(F.col("page_idx") < F.col("end_"), "front").when(F.col("page_idx") >= F.col("back_"), "back").otherwise("body")
    return s.withColumn("region", region).drop("end_", "back_", "n_")


def typed(blk: DataFrame, low_confidence: float = 0.6, notes: DataFrame | None = None, compose: bool = False) -> DataFrame:
    """Blocks in reading order with id, type, level, chapter, region, citation cues and review flag.

    Types are decided in steps: the label; a running head or heading of contents, index or bibliography passes its kind on
    to the blocks below it, headings across pages until the next one; lines of contents beat notes; notes(doc_id, page_idx,
    block_idx, note_type), if given, beat labels; then what shape and region say: verses, quotes, epigraphs and list items
    for body blocks, furniture for all but tables, copyright and contents for all but headings and tables.
    """
    key = [*PAGE, "block_idx"]
    page = Window.partitionBy(*PAGE)
    # one shuffle by document; every window below is within one
    b = signs(blk.repartition("doc_id"))
    b = regions(b.withColumns({k: c.over(page) for k, c in signals().items()}))
    sparse = (F.col("region") == "front") & ~F.col("copyright") & ~F.col("toc") & (F.col("prose") == 0) & (F.col("n_blocks") <= 8)
    head_nav = F.when(F.col("label").isin("PageHeader", "Page-header"), T.nav_of_head(F.col("text")))
    b = b.withColumns({"title_page": sparse, "head_nav": head_nav}).drop("copyright", "toc", "prose", "back", "n_blocks")
    b = b.withColumn("page_nav", F.min_by("head_nav", F.when(F.col("head_nav").isNotNull(), F.col("block_idx"))).over(page)).drop("head_nav")
    b = with_overlaps(reading_order(b)).withColumnRenamed("overlaps", "unsure")
    b = b.join(notes, key, "left") if notes is not None else b.withColumn("note_type", F.lit(None).cast("string"))
    doc = Window.partitionBy("doc_id").orderBy("page_idx", "seq")
    so_far = doc.rowsBetween(Window.unboundedPreceding, 0)
    raw = F.col("text")
    b = b.withColumns({"norm": T.normalize(raw, compose=compose), "base": label_type(F.col("label"))}).withColumn("heading", F.col("base") == "heading")
    norm = F.col("norm")
    b = b.withColumn("nav", F.last(F.when(F.col("heading"), F.struct(T.nav(norm).alias("nav"))), ignorenulls=True).over(so_far)["nav"])
    b = b.withColumn("chapter", F.last(F.when(F.col("heading"), T.chapter(norm)), ignorenulls=True).over(so_far))
    nav = F.coalesce("page_nav", "nav")
    kind = F.when(F.col("base").isin("body", "list_item") & F.col("note_type").isNull() & nav.isNotNull(), nav).when(F.col("base").isin("page_header", "page_footer") & norm.rlike("(?i)" + T.PAGE_NUMBER), "page_number").otherwise(F.col("base"))
    b = b.withColumn("kind", kind)
    claimed = F.col("note_type").isNotNull() | F.col("kind").isin("footnote", "endnote")
    in_toc = F.coalesce(F.col("page_nav") == "toc", F.lit(False)) | F.coalesce(F.col("nav") == "toc", F.lit(False))
    b = b.withColumn("kind", F.when(claimed & T.note_is_toc(norm, in_toc), "toc").otherwise(F.coalesce("note_type", "kind")))
    sign, region = F.coalesce("sign", F.lit("")), F.col("region")
    lines = F.size(T.lines(raw))
    shape = (
        F.when((region == "back") & ((sign == "copyright") | (F.col("heading") & raw.rlike("(?iU)" + T.COLOPHON))), "colophon")
        .when((region == "front") & T.is_dedication(raw) & ~sign.isin("copyright", "toc"), "dedication")
        .when((region == "front") & F.col("title_page") & ~sign.isin("copyright", "toc", "page_header", "page_footer", "page_number", "epigraph", "dedication"), "title_page")
        .when((region != "body") & sign.isin("verse", "quote"), F.when(~F.col("title_page") & (lines >= 3), "epigraph"))
        .otherwise(F.col("sign"))
    )
    b = b.withColumn("shape", shape)
    final = (
        F.when(F.col("shape").isin("verse", "quote", "list_item", "epigraph"), F.when(F.col("kind") == "body", F.col("shape")).otherwise(F.col("kind")))
        .when(F.col("shape").isin("page_header", "page_footer", "page_number", "title_page", "dedication", "colophon"), F.when(F.col("kind") != "table", F.col("shape")).otherwise(F.col("kind")))
        .when(F.col("shape").isNotNull() & ~F.col("kind").isin("heading", "table"), F.col("shape"))
        .otherwise(F.col("kind"))
    )
    b = b.withColumn("type", final)
    noted = F.col("kind").isin("footnote", "endnote")
    b = b.withColumn("text", F.when(noted, T.without_mark(norm)).when(F.col("type").isin("verse", "epigraph") & (F.col("kind") == "body"), T.normalize(raw, False, compose)).otherwise(norm))
    before = F.lag("text", 1, "").over(doc)
    b = b.withColumn("before_", before)
    lead, source = T.lead_in(F.col("before_")), T.trailing_source(F.col("text"))
    b = b.withColumns({"colon": T.after_colon(F.col("before_")), "lead_in": lead, "source": source})
    b = b.withColumn("quote_candidate", (F.col("type") == "body") & (F.col("lead_in") | F.col("source").isNotNull()))
    review = F.coalesce(F.col("confidence") < low_confidence, F.lit(False)) | F.coalesce("unsure", F.lit(False)) | F.col("quote_candidate")
    b = b.withColumns({"needs_review": review, "id": F.format_string("b%05d", F.row_number().over(doc)), "level": F.when(F.col("heading"), T.heading_level(F.col("html"), F.col("label")))})
    return b.drop("before_", "heading", "base", "kind", "norm", "shape", "sign")
