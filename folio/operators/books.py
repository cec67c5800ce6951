"""Books as folders of files: what is there, which editions they are, whether they are finished, and their manifest rows.

A listing is files(path, size); sources.readers.file_listing() makes one of a folder without reading the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .corpus import corpus_key, native_wins, stamp

#: The files that a finished book is handed on with, by their place in its folder.
ARTIFACTS = {"body_text": "body/all_pages.txt", "full_text": "full/all_pages.txt", "pages_jsonl": "body/pages.jsonl"}
#: Fixed value: smaller holdings are placeholders.
PLACEHOLDER = 4096
IMAGES = r"(?i)\.(png|jpe?g)$"


def folder_of(path: Column) -> Column:
    """The book's folder: that of the file, or the one above where the file lies in one of a book's own two."""
    return F.regexp_replace(path, r"(/(body|full))?/[^/]*$", "")


def folders(files: DataFrame) -> DataFrame:
    """A row per folder of a book: its document, artifacts, the first PDF and the first that isn't of the front matter alone; null for what isn't there."""
    f = files.select("path", folder_of(F.col("path")).alias("folder"))
    name = F.substring_index("path", "/", -1)
    own = F.col("path") == F.concat("folder", F.lit("/"), name)
    first = lambda test: F.min(F.when(test, F.col("path")))
    parts = {k: first(F.col("path") == F.concat("folder", F.lit(f"/{v}"))) for k, v in ARTIFACTS.items()}
    pdf = own & name.endswith(".pdf")
    parts |= {"doc_json": first(own & name.endswith(".doc.json")), "pdf": first(pdf), "final_pdf": first(pdf & ~name.endswith("_frontmatter.pdf"))}
    return f.groupBy("folder").agg(*[v.alias(k) for k, v in parts.items()])


def identified(found: DataFrame, sidecars: DataFrame) -> DataFrame:
    """folders() with edition and pub_hint: as sidecars(folder, edition, pub_id) say, else the edition by a name of e and a number."""
    by_name = F.regexp_extract(F.substring_index("folder", "/", -1), r"^e(\d+)$", 1).try_cast("long")
    s = sidecars.groupBy("folder").agg(F.max("edition").alias("edition_"), F.max("pub_id").alias("pub_hint"))
    return found.join(s, "folder", "left").withColumn("edition", F.coalesce("edition_", by_name)).drop("edition_")


def editions(found: DataFrame, sidecars: DataFrame) -> DataFrame:
    """The folders with a document and an edition; of one edition's folders the last by name."""
    known = identified(found, sidecars).filter("doc_json IS NOT NULL AND edition IS NOT NULL")
    others = [c for c in known.columns if c not in ("edition", "folder")]
    last = known.groupBy("edition").agg(F.max_by(F.struct("folder", *others), "folder").alias("f"))
    return last.select("edition", "f.*")


def holding_paths(holdings: DataFrame, files: DataFrame) -> DataFrame:
    """Per edition of holdings(edition_id, file_path) the first PDF that is there and is no placeholder."""
    there = files.filter(F.lower("path").endswith(".pdf") & (F.col("size") > PLACEHOLDER))
    return holdings.join(there, holdings["file_path"] == there["path"]).groupBy("edition_id").agg(F.min("file_path").alias("path"))


def book_dirs(manifest: DataFrame | None, found: DataFrame, trees: tuple[str, ...] = ()) -> DataFrame:
    """Folders of books with pos: of manifest(line, doc_json) in the order of their first lines, else those below trees that have a document, by tree and name."""
    if manifest is not None:
        at = F.regexp_replace("doc_json", r"/[^/]*$", "")
        return manifest.groupBy(at.alias("folder")).agg(F.min("line").alias("pos"))
    tree = F.coalesce(*[F.when(F.col("folder").startswith(t + "/"), F.lit(i)) for i, t in enumerate(trees)], F.lit(None).cast("int"))
    return found.filter("doc_json IS NOT NULL").select("folder", tree.alias("pos")).filter("pos IS NOT NULL")


def resolve_inputs(inputs: DataFrame, files: DataFrame, worklists: DataFrame) -> DataFrame:
    """inputs(ord, path) as books: a PDF is one; a list is one per line of worklists(path, no, line) that isn't blank or a comment; a folder is one per PDF right in it, or itself.

    What is none of these stays, for its run to report.
    """
    pdf, lst = F.lower("path").endswith(".pdf"), F.lower("path").rlike(r"\.(txt|list)$")
    line = F.trim("line")
    lines = worklists.filter((line != "") & ~line.startswith("#")).select("path", F.col("no").alias("sub"), line.alias("source"))
    inside = files.filter(F.lower("path").endswith(".pdf")).select(F.regexp_replace("path", r"/[^/]*$", "").alias("path"), F.lit(0).alias("sub"), F.col("path").alias("source"))
    several = inputs.filter(lst).join(lines, "path")
    held = inputs.filter(~pdf & ~lst).join(inside, "path", "left").withColumns({"sub": F.coalesce("sub", F.lit(0)), "source": F.coalesce("source", "path")})
    alone = inputs.filter(pdf).withColumns({"sub": F.lit(0), "source": F.col("path")})
    return alone.unionByName(several).unionByName(held).select("ord", "sub", "source")


def is_done(found: DataFrame, health: DataFrame) -> DataFrame:
    """found with done: there is a final PDF, and health(folder, ok) says that the book is sound."""
    return found.join(health.select("folder", "ok"), "folder", "left").withColumn("done", F.col("final_pdf").isNotNull() & F.coalesce("ok", F.lit(False)))


def usable_cache(text: Column) -> Column:
    """Whether a cache's JSON is an object with a page or more."""
    return F.coalesce(F.size(F.json_object_keys(text)) > 0, F.lit(False))


def markers(health: DataFrame) -> DataFrame:
    """The marker of health(folder, ok, reasons, n_blocks, n_pages): the file to write, the one to clear, and its JSON."""
    name = lambda ok: F.concat("folder", F.when(ok, F.lit("/.ocr_ok")).otherwise(F.lit("/.ocr_incomplete")))
    return health.select("folder", name(F.col("ok")).alias("path"), name(~F.col("ok")).alias("clear"), F.to_json(F.struct("ok", "reasons", "n_blocks", "n_pages")).alias("json"))


def ingest_rows(found: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows of the ingestion manifest: docs(folder, doc_id, title, source, schema_version, features, n_blocks) with the files of their folders; a folder without a document has what a document would say empty."""
    j = found.join(docs, "folder", "left")
    return j.select(F.substring_index("folder", "/", -1).alias("edition"), "title", "doc_id", "source", "schema_version", F.coalesce("features", F.array().cast("array<string>")).alias("features"), F.coalesce("n_blocks", F.lit(0)).alias("n_blocks"), "doc_json", "pdf", "body_text", "pages_jsonl")


def corpus_rows(found: DataFrame, sidecars: DataFrame, docs: DataFrame, strict: bool = True) -> DataFrame:
    """Rows of the exported corpus: keyed by the public id, else the edition, else the folder's name, with paths below that key.

    docs may have cached, whether the book was recognised from images. A book without a document stops the job; with
    strict=False it is left out.
    """
    known = identified(found, sidecars).join(docs, "folder", "left")
    folder = F.substring_index("folder", "/", -1)
    if strict:
        known = known.withColumn("doc_json", F.coalesce("doc_json", F.raise_error(F.concat(folder, F.lit(": no document to export"))).cast("string")))
    known = known.filter("doc_json IS NOT NULL").withColumn("key", corpus_key(F.col("pub_hint"), F.col("edition"), folder))
    below = lambda c, rel: F.when(F.col(c).isNotNull(), F.concat("key", F.lit("/"), rel)).alias(c)
    kind = F.when(F.col("cached"), "scanned").otherwise("native") if "cached" in known.columns else F.lit("native")
    paths = [below("doc_json", F.substring_index("doc_json", "/", -1)), *[below(k, F.lit(v)) for k, v in ARTIFACTS.items()]]
    return known.select("key", F.col("pub_hint").alias("pub_id"), F.coalesce(F.concat(F.lit("e"), "edition"), folder).alias("edition"), "doc_id", "title", kind.alias("kind"), "source", "schema_version", *paths, F.coalesce("n_blocks", F.lit(0)).alias("n_blocks"), F.lit(True).alias("nfc"))


def hand_off(native: DataFrame, scanned: DataFrame, docs: DataFrame, holdings: DataFrame) -> DataFrame:
    """The manifest of both trees' editions(): native ones win; with their documents, their public id and content hash, and complete: both document and body text are there."""
    rows = native_wins(native, scanned).join(docs, "folder", "left")
    ids = stamp(rows.select("edition", "source", "pub_hint"), holdings).select("edition", F.col("stamped").alias("pub_id"), "content_hash")
    out = rows.drop("pub_hint").join(ids, "edition")
    return out.withColumn("complete", F.col("doc_json").isNotNull() & F.col("body_text").isNotNull())


def resumable(states: DataFrame) -> DataFrame:
    """Of book_state() the books that another run would go on with or do again, by name."""
    return states.filter(F.col("state").isin("resume", "broken")).orderBy("book")


def count_pages(sources: DataFrame, files: DataFrame, limit: int | None = None) -> DataFrame:
    """Pages of sources(source, pdf_pages): of a PDF its pages, at most limit; of a folder its images; 0 for what can't be read."""
    images = files.filter(F.col("path").rlike(IMAGES)).groupBy(F.regexp_replace("path", r"/[^/]*$", "").alias("source")).agg(F.count(F.lit(1)).alias("images"))
    pdf = F.least("pdf_pages", F.lit(limit)) if limit else F.col("pdf_pages")
    return sources.join(images, "source", "left").select("source", F.coalesce("images", pdf, F.lit(0)).cast("long").alias("pages"))


def rendered(pages: DataFrame, two_up: str = "auto") -> DataFrame:
    """pages(base, ext, w, h, split) as the files that they are saved in, with their bounds.

    A page that is wider by 1.15 than high is two: cut at split where that is found ("auto"), or in the middle ("on").
    """
    wide = F.col("w") >= F.col("h") * 1.15
    cut = {"off": F.lit(None).cast("int"), "auto": F.when(wide, F.nullif(F.col("split"), F.lit(0))), "on": F.when(wide, F.floor(F.col("w") / 2).cast("int"))}[two_up]
    part = lambda side, a, z: F.struct(F.concat("base", F.lit(side), F.lit("."), "ext").alias("name"), a.cast("int").alias("x0"), z.cast("int").alias("x1"))
    both = F.array(part("a", F.lit(0), cut), part("b", cut, F.col("w")))
    return pages.select("base", F.explode(F.when(cut.isNotNull(), both).otherwise(F.array(part("", F.lit(0), F.col("w"))))).alias("p")).select("base", "p.*")


def strips(pages: DataFrame) -> DataFrame:
    """pages(stem, w, cuts) as strips between their cuts: <stem>__c<i> with its bounds; strips under two pixels are left out, and keep their number."""
    bounds = F.concat(F.array(F.lit(0)), "cuts", F.array("w"))
    p = pages.select("stem", F.posexplode(F.arrays_zip(F.slice(bounds, 1, F.size(bounds) - 1).alias("x0"), F.slice(bounds, 2, F.size(bounds)).alias("x1"))).alias("i", "b"))
    return p.filter("b.x1 - b.x0 >= 2").select("stem", F.concat("stem", F.lit("__c"), "i").alias("strip"), "b.x0", "b.x1")


def line_texts(blocks: DataFrame, boxes: DataFrame, key: list[str]) -> DataFrame:
    """Words of blocks(key, text) dealt to the line boxes(key, box, y, width) of their block, in proportion to the widths: (key, box, line); a block without boxes is one line, box 0.

    A word goes to the first box whose share of the width isn't used up by the words before it; a word is as wide as its
    characters and a space, as fonts aren't known here.
    """
    words = blocks.select(*key, F.posexplode(F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " ")).alias("pos", "word")).filter("word <> ''")
    size = F.length("word") + 1
    w = Window.partitionBy(*key)
    words = words.withColumns({"before": F.sum(size).over(w.orderBy("pos")) - size, "all_": F.sum(size).over(w)})
    b = Window.partitionBy(*key)
    lines = boxes.withColumns({"upto": F.sum("width").over(b.orderBy("y", "box").rowsBetween(Window.unboundedPreceding, 0)), "whole": F.sum("width").over(b), "nth": F.row_number().over(b.orderBy("y", "box"))})
    dealt = words.join(lines, key, "left")
    # whole numbers: before / all_ < upto / whole, or the last box
    fits = F.col("box").isNull() | (F.col("before") * F.col("whole") < F.col("upto") * F.col("all_"))
    at = dealt.filter(fits).groupBy(*key, "pos", "word").agg(F.min_by("box", "nth").alias("box"))
    return at.groupBy(*key, F.coalesce("box", F.lit(0)).alias("box")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]), " ").alias("line"))
