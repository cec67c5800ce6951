"""Readers of the engine's files: caches, detection and layout boxes, manifests, work lists, rules, logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

#: Image extensions of pages (fixed values).
IMAGES = ["jpg", "jpeg", "png", "tif", "tiff", "webp", "bmp"]
#: What a server's log says of a finished task (a fixed format).
EVAL = r"task (\d+) \|\s+eval time =\s+[\d.]+ ms /\s+(\d+) tokens"
_BOXES = "array<struct<text: string, html: string, label: string, raw_label: string, confidence: double, bbox: array<double>, polygon: array<array<double>>>>"
CACHE = f"map<string, array<struct<blocks: {_BOXES}, text_lines: {_BOXES}, lines: {_BOXES}, image_bbox: array<double>, page: int>>>"


def stem(name: Column) -> Column:
    """The file name without folders and extension."""
    return F.regexp_replace(F.substring_index(name, "/", -1), r"\.[^.]*$", "")


def box(bbox: Column, polygon: Column) -> Column:
    """A box, or that around a polygon, or null."""
    x, y = F.transform(polygon, lambda p: p[0]), F.transform(polygon, lambda p: p[1])
    around = F.array(F.array_min(x), F.array_min(y), F.array_max(x), F.array_max(y))
    return F.coalesce(F.when(F.size(bbox) >= 4, bbox), F.when(F.size(polygon) > 0, around))


def _pages(spark: SparkSession, path: str) -> DataFrame:
    """key, k, p of every page entry of a JSON object {key: [page, ...]} in whole files; what doesn't parse has none."""
    raw = spark.read.text(path, wholetext=True)
    parsed = raw.select(F.from_json("value", CACHE, {"mode": "PERMISSIVE"}).alias("m"))
    return parsed.select(F.explode("m").alias("key", "ps")).select("key", F.posexplode("ps").alias("k", "p"))


def load_pages(spark: SparkSession, path: str) -> DataFrame:
    """The engine's cache as blocks: page_name, page_no, page_w, page_h, block_idx, label, text, html, confidence, x0, y0, x1, y1.

    Boxes stand in blocks, text_lines or lines; a block's text is its own or that of its HTML, and blank ones are left out;
    a block without a box has the page's; the page's size is that of image_bbox, else 1000 x 1000.
    """
    p = _pages(spark, path)
    size = lambda i, j: F.coalesce(F.get("p.image_bbox", F.lit(i)) - F.get("p.image_bbox", F.lit(j)), F.lit(1000.0)).cast("int")
    p = p.select("key", F.coalesce("p.page", F.lit(0)).alias("page_no"), size(2, 0).alias("page_w"), size(3, 1).alias("page_h"), F.posexplode(F.coalesce("p.blocks", "p.text_lines", "p.lines")).alias("i", "b"))
    text = F.coalesce(F.nullif(F.col("b.text"), F.lit("")), T.html_text("b.html"))
    b = p.withColumns({"text": text, "box": F.coalesce(box(F.col("b.bbox"), F.col("b.polygon")), F.array(F.lit(0.0), F.lit(0.0), F.col("page_w").cast("double"), F.col("page_h").cast("double")))})
    b = b.filter(T.strip(F.col("text")) != "")
    sides = [F.col("box")[i].alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))]
    return b.select(F.col("key").alias("page_name"), "page_no", "page_w", "page_h", F.col("i").alias("block_idx"), F.coalesce("b.label", "b.raw_label").alias("label"), "text", F.col("b.html").alias("html"), F.col("b.confidence").alias("confidence"), *sides)


def load_boxes(spark: SparkSession, path: str, labelled: bool = False) -> DataFrame:
    """Detected lines, or with labelled layout regions: stem, idx, label, x0, y0, x1, y1; regions without a label are left out."""
    p = _pages(spark, path).select(stem(F.col("key")).alias("stem"), F.posexplode(F.coalesce("p.blocks", "p.text_lines", "p.lines")).alias("idx", "b"))
    b = p.withColumns({"box": box(F.col("b.bbox"), F.col("b.polygon")), "label": F.coalesce("b.label", "b.raw_label")}).filter("box IS NOT NULL")
    b = b.filter("label IS NOT NULL") if labelled else b
    return b.select("stem", "idx", "label", *[F.col("box")[i].alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))])


def native_blocks(spans: DataFrame, dpi: int) -> DataFrame:
    """Embedded text as blocks: spans(page_idx, block_idx, kind, lines: array of arrays of span texts, x0, y0, x1, y1), in points, scaled; blank ones are left out."""
    joined = F.filter(F.transform("lines", lambda line: F.array_join(line, "")), lambda x: x.rlike(r"(?U)\S"))
    out = spans.withColumns({"text": F.when(F.col("kind") == "image", "").otherwise(T.strip(F.array_join(joined, "\n"))), "label": F.when(F.col("kind") == "image", "Picture")})
    out = out.filter((F.col("kind") == "image") | (F.col("text") != ""))
    return out.select("page_idx", "block_idx", "label", "text", *[(F.col(c) * dpi / 72).alias(c) for c in ("x0", "y0", "x1", "y1")])


def manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON lines file; blank and half-written lines are left out."""
    rows = spark.read.text(path).select(F.from_json("value", schema).alias("r")).select("r.*")
    return rows.filter(F.col(rows.columns[0]).isNotNull())


def work_list(spark: SparkSession, path: str, default: int | None = None) -> DataFrame:
    """entry, limit of a list whose lines are an entry and, after a tab or ::, a limit; blank lines and comments are left out."""
    line = T.strip(F.col("value"))
    rows = spark.read.text(path).select(line.alias("v")).filter("v <> '' AND NOT startswith(v, '#')")
    parts = F.split("v", r"\t| :: ")
    return rows.select(T.strip(parts[0]).alias("entry"), F.coalesce(F.get(parts, F.lit(1)).try_cast("int"), F.lit(default).cast("int")).alias("limit"))


def layout_rules(spark: SparkSession, path: str) -> DataFrame:
    """ord, key, opt, val of a rules file; a line without a key or with an unknown directive stops the job with its number."""
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("no", "line"))
    rows = rows.withColumn("line", T.strip(F.regexp_replace("line", "#.*$", ""))).filter("line <> ''")
    at = F.split("line", r"\t| :: |::", 2)
    rows = rows.select("no", T.strip(F.get(at, F.lit(0))).alias("key"), F.get(at, F.lit(1)).alias("rest"))
    word = rows.select("no", "key", F.explode(F.split(F.coalesce(T.strip(F.col("rest")), F.lit("")), r"[,\s]+")).alias("d"))
    name, val = F.replace(F.lower(F.split_part("d", F.lit("="), F.lit(1))), F.lit("-"), F.lit("_")), F.lower(F.split_part("d", F.lit("="), F.lit(2)))
    opt = F.when(name.isin("columns", "column", "two_column", "two_columns"), "columns").when(name == "two_up", "two_up").when(name.isin("drop_pages", "skip_pages"), "drop_pages")
    val = F.when(name.startswith("two_column"), "2").when((name == "two_up") & (val == ""), "on").otherwise(val)
    good = ((opt == "columns") & (val.try_cast("int") >= 1)) | ((opt == "two_up") & val.isin("on", "auto", "off")) | ((opt == "drop_pages") & val.rlike(r"^(even|odd|non-latin)(:|$)"))
    bad = F.raise_error(F.concat(F.lit("bad layout rule in line "), F.col("no") + 1))
    return word.select((F.col("no") + 1).alias("ord"), F.when(F.coalesce(good, F.lit(False)) & (F.col("key") != ""), F.col("key")).otherwise(bad).alias("key"), opt.alias("opt"), val.alias("val"))


def sidecar_edition(rows: DataFrame) -> DataFrame:
    """rows(folder, json) with edition: the sidecar's, else that of a folder named e<number>."""
    named = F.regexp_extract(F.substring_index("folder", "/", -1), r"^e(\d+)$", 1)
    return rows.withColumn("edition", F.coalesce(F.get_json_object("json", "$.edition"), F.nullif(named, F.lit(""))))


def perf_lines(spark: SparkSession, path: str, marker: str = "[PERF]") -> DataFrame:
    """The summaries of stage ocr that a log holds as JSON behind a marker: their fields, and the JSON itself."""
    rows = spark.read.text(path).filter(F.contains("value", F.lit(marker)))
    j = T.strip(F.expr(f"substring(value, instr(value, '{marker}') + {len(marker)})"))
    said = F.get_json_object("j", "$.summary")
    rows = rows.select(j.alias("j")).filter((F.get_json_object("j", "$.stage") == "ocr") & said.isNotNull() & ~said.isin("false", "0", "", "{}", "[]"))
    return rows.select(F.from_json("j", "map<string, string>").alias("fields"), F.col("j").alias("json"))


def decoded_tokens(spark: SparkSession, path: str) -> DataFrame:
    """log, task, tokens of lines that report how many tokens a task has decoded."""
    rows = spark.read.text(path).filter("value LIKE '%eval time%' AND value NOT LIKE '%prompt eval%'")
    at = lambda g, kind: F.regexp_extract("value", EVAL, g).try_cast(kind)
    return rows.select(F.col("_metadata.file_path").alias("log"), at(1, "long").alias("task"), at(2, "int").alias("tokens")).filter("task IS NOT NULL")


def page_images(spark: SparkSession, folder: str) -> DataFrame:
    """Files of page images below a folder, with their natural order."""
    from ..operators.pages import natural_key

    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).drop("content")
    name = F.substring_index("path", "/", -1)
    return rows.filter(F.lower(F.substring_index("path", ".", -1)).isin(IMAGES)).select("path", name.alias("name"), "modificationTime", "length", natural_key(name).alias("order"))


def file_listing(spark: SparkSession, folder: str) -> DataFrame:
    """The files below folder: path and size; their content isn't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select(F.regexp_replace("path", "^file:/*", "/").alias("path"), F.col("length").alias("size"))
