"""Footnotes and endnotes: an exact resolver per document, and the parts of it that windows can express."""

from __future__ import annotations

import itertools
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .geometry import PAGE
from .pages import page_no

ANNOTATIONS = "doc_id long, page_idx int, block_idx int, note_type string, note_marker string, scope_key string, continuation boolean, page_no long, note_no int, piece int, body string, note_chapter string, review boolean"
_END = tuple(".!?\"')]”’…")


def band(blk: DataFrame, low: float = 0.70) -> DataFrame:
    """blk with in_band: a footnote by label, or low on a page without a raster."""
    return blk.withColumn("in_band", (F.col("label") == "Footnote") | (F.col("y0") >= low * F.col("page_h")))


def note_pages(blk: DataFrame) -> DataFrame:
    """Per page whether it looks like a page of endnotes: three marked blocks, half of all, one of them in the upper half."""
    skip = F.col("label").isin("PageHeader", "PageFooter", "SectionHeader", "Title") | (T.strip(F.col("text")) == "")
    m = T.marker(F.col("text")).isNotNull()
    g = blk.filter(~skip).groupBy(*PAGE).agg(F.count_if(m).alias("marked"), F.count(F.lit(1)).alias("n"), F.bool_or(m & (F.col("y0") < 0.5 * F.col("page_h"))).alias("upper"))
    heads = blk.groupBy(*PAGE).agg(F.bool_or(F.col("label").isin("SectionHeader", "Title") & T.is_notes_heading(F.col("text"))).alias("headed"))
    looks = F.coalesce((F.col("marked") >= 3) & (F.col("marked") >= F.floor(F.col("n") / 2)) & F.col("upper"), F.lit(False))
    return heads.join(g, PAGE, "left").select(*PAGE, "headed", looks.alias("looks"))


def footnote_islands(blk: DataFrame) -> DataFrame:
    """Notes in the bands of pages: a marked block and the unmarked ones below it; island 0 is what stands before any mark."""
    b = band(blk).filter("in_band").withColumn("marker", T.marker(F.col("text"), True))
    w = Window.partitionBy(*PAGE).orderBy("y0", "block_idx")
    b = b.withColumn("island", F.sum(F.col("marker").isNotNull().cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("y0", "block_idx", "text"))), lambda x: x["text"]), " ")
    return b.groupBy(*PAGE, "island").agg(F.max("marker").alias("marker"), F.count(F.lit(1)).alias("n_blocks"), body.alias("note_text"))


def endnote_keys(blk: DataFrame) -> DataFrame:
    """Marked blocks of pages of endnotes, with the chapter of the last notes heading before them and their key."""
    pages = note_pages(blk).filter("headed OR looks").select(*PAGE)
    b = blk.join(pages, PAGE, "left_semi")
    is_head = F.col("label").isin("SectionHeader", "Title") & T.is_notes_heading(F.col("text"))
    w = Window.partitionBy("doc_id").orderBy("page_idx", "block_idx").rowsBetween(Window.unboundedPreceding, 0)
    b = b.withColumn("scope", F.last(F.when(is_head, F.struct(T.notes_scope(F.col("text")).alias("chapter"))), ignorenulls=True).over(w)["chapter"])
    b = b.filter(~is_head & ~F.col("label").isin("PageHeader", "PageFooter", "SectionHeader", "Title")).withColumn("marker", T.marker(F.col("text"), True)).filter("marker IS NOT NULL")
    return b.withColumn("scope_key", F.concat(F.coalesce(F.concat(F.lit("ch"), "scope"), F.lit("book")), F.lit(":"), "marker"))


# the exact form: one pass over a document's pages

_MARKS = [re.compile(p) for p in (r"\s*\[\^([^\]]+)\]\s*", r"\s*[\(\[]?(\d{1,4})[\)\]]?[.):]\s*", r"\s*[\(\[](\d{1,4})[\)\]]\s*", rf"\s*([{T.SYMBOLS}]+)\s*", r"\s*(\d{1,4})\s+")]
_REF = re.compile(r"\[\^([^\]]+)\]|\[(\d{1,3})\]")
_HEADING = re.compile("endnotes|referencenotes|chapternotes|notes")


def _split(text: str) -> tuple[str | None, str]:
    for p in _MARKS:
        if m := p.match(text):
            return m[1], text[m.end() :]
    return None, text


def _scope(text: str) -> tuple[bool, str | None]:
    t = re.sub(r"\s+", "", text).lower()
    if not _HEADING.match(t):
        return False, None
    m = re.search(r"chapter(\w+)$", t) or re.search(r"to(?:the)?(\w+)$", t)
    return True, m[1] if m else None


def _plausible(marker: str, before: str) -> bool:
    """Whether a mark can be the one after `before`: a number may leave one out; other signs always can."""
    return not (marker.isdigit() and before.isdigit()) or 0 < int(marker) - int(before) <= 2


class _Notes:
    """The notes of one document so far, as the blocks that they are made of; later notes replace earlier ones of the same key."""

    def __init__(self) -> None:
        self.number = 0
        self.by_key: dict[str, tuple[int, str, str]] = {}  # number, marker, last piece of text
        self.open: str | None = None
        self.blocks: list[tuple] = []

    def put(self, b: dict, key: str, marker: str, kind: str, text: str, chapter: str | None, review: bool) -> None:
        self.number += 1
        self.by_key[key] = (self.number, marker, text)
        self.blocks.append((b["page_idx"], b["block_idx"], kind, marker, key, False, b["page_no"], self.number, len(self.blocks), text, chapter, review))

    def go_on(self, b: dict, key: str, kind: str) -> None:
        number, marker, _ = self.by_key[key]
        text = b["text"].strip()
        self.by_key[key] = (number, marker, text)
        self.blocks.append((b["page_idx"], b["block_idx"], kind, None, key, True, b["page_no"], number, len(self.blocks), text, None, False))

    def closed(self, key: str | None) -> str | None:
        """key, if its note doesn't end like a sentence."""
        if key is None:
            return None
        end = self.by_key[key][2].rstrip()
        return None if not end or end.endswith(_END) else key


def _footnotes(state: _Notes, page: list[dict], number: int) -> str | None:
    """A page's band of footnotes. What has no mark goes on with the note before it, on the page or, until that ends like a
    sentence, with the one left open on the page before; else it takes the page's first reference that no note before it has."""
    band = sorted((b for b in page if b["in_band"]), key=lambda b: b["y0"])
    refs = [m[1] or m[2] for b in page if not b["in_band"] for m in _REF.finditer(b["text"])]
    found: list[list] = []  # marker, text, blocks
    for b in band:
        marker, rest = _split(b["text"])
        if marker is None and not found and state.open:
            state.go_on(b, state.open, "footnote")
            state.open = state.closed(state.open)
        elif marker is None and found:
            found[-1][2].append(b)
        else:
            found.append([marker, rest.strip(), [b]])
    used: set[str] = set()
    last = None
    for marker, text, blocks in found:
        review = marker is None or marker not in refs
        if marker is None:
            marker = next((r for r in refs if r not in used), None)
            if marker is None:
                continue
        used.add(marker)
        last = f"p{number}:{marker}"
        state.put(blocks[0], last, marker, "footnote", text, None, review)
        for b in blocks[1:]:
            state.go_on(b, last, "footnote")
    return last


def _endnotes(state: _Notes, page: list[dict], number: int, chapter: str | None) -> tuple[str | None, str | None]:
    last, first, open_ = None, True, state.open
    for b in page:
        if b["label"] in ("PageHeader", "PageFooter") or not b["text"].strip():
            continue
        if b["label"] in ("SectionHeader", "Title"):
            is_head, scope = _scope(b["text"])
            if is_head:
                chapter, open_ = scope, None
            continue
        marker, rest = _split(b["text"])
        # before the page's first note a number may belong to the text of the note that is still open
        if marker is not None and first and last is None and open_ and not _plausible(marker, state.by_key[open_][1]):
            marker = None
        if marker is None:
            if last is None and first:
                last, open_ = open_, None
            if last:
                state.go_on(b, last, "endnote")
            continue
        first = False
        last = f"ch{chapter}:{marker}" if chapter else f"book:{marker}"
        state.put(b, last, marker, "endnote", rest.strip(), chapter, False)
    return last, chapter


def _resolved(rows: pd.DataFrame) -> _Notes:
    columns = [rows[c].tolist() for c in rows.columns]
    blocks = sorted((dict(zip(rows.columns, r, strict=True)) for r in zip(*columns, strict=True)), key=lambda b: (b["page_idx"], b["block_idx"]))
    state, chapter = _Notes(), None
    for _, page in itertools.groupby(blocks, key=lambda b: b["page_idx"]):
        page = list(page)
        number = page[0]["page_no"]
        if page[0]["notes_page"]:
            last, chapter = _endnotes(state, page, number, chapter)
        else:
            last = _footnotes(state, page, number)
        state.open = state.closed(last)
    return state


def _document(rows: pd.DataFrame) -> pd.DataFrame:
    names = [c.split()[0] for c in ANNOTATIONS.split(", ")]
    doc = rows["doc_id"].iloc[0]
    return pd.DataFrame([(doc, *x) for x in _resolved(rows).blocks], columns=names)


def printed_no(blk: DataFrame) -> Column:
    """The number by which notes name a page: that of its file's name, else its index."""
    at = F.col("page_idx").cast("long")
    return F.coalesce(page_no(F.col("page_name"), F.lit(None).cast("long"), at), at) if "page_name" in blk.columns else at


def annotations(blk: DataFrame) -> DataFrame:
    """The blocks that notes are made of, exactly: notes that run over pages, marks that must be guessed, and their scopes.

    The state passes from page to page, so a document is one group; a document's blocks are bounded by its pages.
    """
    pages = note_pages(blk).select(*PAGE, (F.col("headed") | F.col("looks")).alias("notes_page"))
    b = band(blk).join(pages, PAGE).select("doc_id", "page_idx", "block_idx", "label", "text", "y0", "in_band", "notes_page", printed_no(blk).alias("page_no"))
    return b.groupBy("doc_id").applyInPandas(_document, ANNOTATIONS)


def resolve(blk: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """The notes of all documents, from annotations(blk), which may be given: one row a key, the last note of that key."""
    found = annotations(blk) if found is None else found
    pieces = F.sort_array(F.collect_list(F.struct("piece", "body", "page_no")))
    head = lambda c: F.max(F.when(~F.col("continuation"), F.col(c)))
    n = found.groupBy("doc_id", "scope_key", "note_no").agg(pieces.alias("p"), head("note_marker").alias("marker"), head("note_type").alias("kind"), head("note_chapter").alias("chapter"), F.max("review").alias("needs_review"))
    last = n.groupBy("doc_id", "scope_key").agg(F.max_by(F.struct("p", "marker", "kind", "chapter", "needs_review"), "note_no").alias("n")).select("doc_id", "scope_key", "n.*")
    pages = F.array_distinct(F.transform("p", lambda x: x["page_no"]))
    text = F.array_join(F.transform("p", lambda x: x["body"]), " ")
    return last.select("doc_id", "scope_key", "marker", "kind", text.alias("text"), F.get(pages, F.lit(0)).alias("page"), "chapter", "needs_review", pages.alias("span_pages"))


def backlinks(typed: DataFrame, blk: DataFrame) -> DataFrame:
    """For each note key of a page the id of the first of its blocks; blk has the texts with their marks."""
    m = blk.filter(F.col("label") == "Footnote").select(*PAGE, "block_idx", T.marker(F.col("text"), True).alias("marker"), printed_no(blk).alias("page_no")).filter("marker IS NOT NULL")
    m = typed.select(*PAGE, "block_idx", "seq", "id").join(m, [*PAGE, "block_idx"])
    m = m.withColumn("scope_key", F.concat(F.lit("p"), "page_no", F.lit(":"), "marker"))
    return m.groupBy("doc_id", "scope_key").agg(F.min_by("id", F.struct("page_idx", "seq")).alias("block_id"))
