"""Block, page, corpus, metric and raster tables derived from the driver's tables (see FIXTURES.md)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Steps from numbered lines (doc_id, line_no, raw) to blocks; the same expressions run in Spark and DuckDB.
BLOCK_STEPS = [
    ["doc_id", "line_no", "raw", "(doc_id * 7 + line_no * 13) % 24 AS k", "1 + line_no % 9 AS n", "cast((line_no - line_no % 8) / 8 AS int) AS page_idx", "cast(line_no % 8 AS int) AS block_idx"],
    ["*", "(doc_id + page_idx) % 4 = 0 AS two", "CASE WHEN block_idx = 0 THEN 'H' WHEN k IN (9, 10, 12) THEN 'S' WHEN k = 13 THEN 'F' ELSE 'T' END AS kind"],
    [
        "*",
        "CASE kind WHEN 'H' THEN 'PageHeader' WHEN 'S' THEN 'SectionHeader' WHEN 'F' THEN 'Footnote' ELSE 'Text' END AS label",
        """CASE WHEN kind = 'H' AND k = 14 THEN 'INDEX OF NAMES' WHEN kind = 'H' THEN cast(page_idx + 1 AS varchar(9)) || ' Sample Folio'
        WHEN k = 0 THEN raw || '[^' || cast(n AS varchar(9)) || ']' WHEN k = 1 THEN cast(n AS varchar(9)) || '. ' || raw WHEN k = 2 THEN 'As the sūtra says:'
        WHEN k = 3 THEN raw || ' (MMK 24.' || cast(n AS varchar(9)) || ')' WHEN k = 4 THEN '10 9 8 7 6 5 4 3 2 1' WHEN k = 5 THEN 'All rights reserved. ISBN ' || cast(n AS varchar(9))
        WHEN k = 6 THEN 'Preface ...... ' || cast(n AS varchar(9)) WHEN k = 7 THEN substr(raw, 1, 30) || chr(10) || substr(raw, 31, 12) || chr(10) || substr(raw, 43, 10)
        WHEN k = 8 THEN '• ' || raw WHEN k = 9 THEN 'Chapter ' || cast(n AS varchar(9)) WHEN k = 10 THEN 'Notes' WHEN k = 12 THEN 'Contents'
        WHEN k = 11 THEN 'exam-' || chr(10) || 'ple ﬁle’s ' || raw WHEN k = 13 THEN '[^' || cast(n AS varchar(9)) || ']' || raw ELSE raw END AS text""",
        "cast(CASE WHEN two AND block_idx >= 4 THEN 540 WHEN two THEN 60 ELSE 100 END + CASE WHEN k = 7 AND kind = 'T' THEN 60 ELSE 0 END AS double) AS x0",
        "cast(CASE WHEN two AND block_idx >= 4 THEN 940 WHEN two THEN 460 ELSE 900 END - CASE WHEN k = 7 AND kind = 'T' THEN 60 ELSE 0 END AS double) AS x1",
        "cast(CASE WHEN kind = 'H' THEN 40 WHEN kind = 'F' THEN 1240 + 12 * block_idx WHEN two THEN 140 + 250 * (block_idx % 4) ELSE 140 + 130 * block_idx END AS double) AS y0",
        "cast(CASE WHEN kind = 'H' THEN 80 WHEN kind = 'F' THEN 1250 + 12 * block_idx WHEN two THEN 240 + 250 * (block_idx % 4) ELSE 240 + 130 * block_idx END + CASE WHEN k = 15 AND kind = 'T' THEN 100 ELSE 0 END AS double) AS y1",
        "CASE WHEN k % 5 <> 0 THEN cast((40 + 5 * (k % 12)) AS double) / 100 END AS confidence",
    ],
    [
        "*",
        "CASE WHEN kind = 'S' THEN '<h' || cast(1 + k % 3 AS varchar(9)) || '>' || text || '</h' || cast(1 + k % 3 AS varchar(9)) || '>' END AS html",
        "'page-' || lpad(cast(page_idx + 1 AS varchar(9)), 4, '0') AS page_name",
        "1000 AS page_w",
        "1400 AS page_h",
    ],
]


def duck_chain(start: str, steps: list[list[str]]) -> str:
    """DuckDB SQL that runs the steps over the table start."""
    sql = start
    for s in steps:
        sql = f"(SELECT {', '.join(s)} FROM {sql})"
    return f"SELECT * FROM {sql}"


#: DuckDB's blk as common table expressions, to put after WITH.
DUCK_BLK = f"""ln AS (SELECT doc_id, line_no, raw FROM (SELECT doc_id, unnest(range(len(l))) AS line_no, unnest(l) AS raw FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)) WHERE trim(raw) <> ''),
blk AS MATERIALIZED ({duck_chain('ln', BLOCK_STEPS)})"""


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir, which all workers reach; below a temporary folder where that is unset and all runs on one machine."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="folio-")
    return f"{at.rstrip('/')}/folio/{name}-{uuid.uuid4().hex[:12]}"


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a block per non-blank line of documents, with label, text, geometry, confidence and html."""
    out = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "raw"))
    out = out.filter(F.trim("raw") != "").withColumn("line_no", F.col("line_no").cast("long"))
    for step in BLOCK_STEPS:
        out = out.selectExpr(*step)
    return out


#: F2 for DuckDB, and the steps after the running number, which both engines run.
FILE_STEPS = [
    ["o_custkey AS book", "o_orderkey", "o_orderdate", "file_idx", "cast(o_orderkey % 12 AS int) AS hk"],
    [
        "*",
        "'Book - ' || CASE WHEN hk % 2 = 0 OR length(cast(file_idx AS varchar(9))) >= 3 THEN cast(file_idx AS varchar(9)) ELSE lpad(cast(file_idx AS varchar(9)), 3, '0') END || '.jpg' AS name",
        "CASE WHEN hk IN (0, 1) THEN CASE WHEN file_idx % 2 = 1 THEN file_idx + 1 ELSE file_idx - 1 END WHEN hk = 5 AND file_idx > 1 THEN file_idx - 1 WHEN hk = 7 THEN file_idx + 40 ELSE file_idx END AS printed",
        "CASE WHEN hk IN (3, 9) THEN NULL WHEN file_idx <= 2 THEN 'roman' ELSE 'arabic' END AS kind",
        "'book-' || cast(book AS varchar(12)) || '-' || cast(file_idx % 7 AS varchar(9)) AS content",
    ],
]
DUCK_FILES = f"""pf0 AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS file_idx FROM orders),
pf AS MATERIALIZED ({duck_chain('pf0', FILE_STEPS)})"""


def page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page files of a book per customer, with printed numbers, some swapped, repeated, misread or missing."""
    from pyspark.sql import Window

    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    out = orders.withColumn("file_idx", F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).cast("long"))
    for step in FILE_STEPS:
        out = out.selectExpr(*step)
    return out


#: F3 rows, for both engines; sha is the engine's sha-256 in hex.
def corpus_step(sha: str) -> list[str]:
    return [
        "p_partkey AS edition",
        f"substr({sha}, 1, 16) AS doc_id",
        "p_name AS title",
        "CASE WHEN p_partkey % 19 = 0 THEN 0 ELSE p_size END AS n_blocks",
        "CASE WHEN p_partkey % 17 <> 0 THEN '1.2' END AS schema_version",
        "cast(p_partkey % 4 AS int) AS cache_pages",
        "p_partkey % 3 = 0 AS native",
        "p_partkey % 2 = 0 AS scanned",
        "CASE WHEN p_partkey % 14 = 0 THEN 's' || cast(p_partkey AS varchar(12)) END AS pub_hint",
    ]


DUCK_CORPUS = f"corpus AS (SELECT {', '.join(corpus_step('sha256(cast(p_partkey AS varchar))'))} FROM part)"
DUCK_HOLDING = """holding AS (SELECT l_partkey AS edition_id, '/h/' || l_partkey || '/' || l_suppkey || '.pdf' AS file_path,
    substr(sha256('/h/' || l_partkey || '/' || l_suppkey || '.pdf'), 1, 16) AS content_hash, CASE WHEN l_partkey % 7 <> 0 THEN 'u' || l_partkey END AS pub_id, l_suppkey AS supp
    FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem))"""


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a corpus row per part."""
    return read(spark, sf_dir, "part").selectExpr(*corpus_step("sha2(cast(p_partkey AS string), 256)"))


def holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the catalogue's view of held files."""
    d = read(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()
    path = F.concat(F.lit("/h/"), "l_partkey", F.lit("/"), "l_suppkey", F.lit(".pdf"))
    return d.select(
        F.col("l_partkey").alias("edition_id"),
        path.alias("file_path"),
        F.substring(F.sha2(path, 256), 1, 16).alias("content_hash"),
        F.when(F.col("l_partkey") % 7 != 0, F.concat(F.lit("u"), "l_partkey")).alias("pub_id"),
        F.col("l_suppkey").alias("supp"),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one metric, gpu.util_pct, of a series per user."""
    return read(spark, sf_dir, "events").select(F.col("user_id").alias("series"), "ts", "event_id", F.col("value").alias("util"), "event_type")


#: F5: stages of a day as (ord, label, from hour, to hour).
STAGES = [(0, "rasterize", 0, 3), (1, "ocr", 3, 15), (2, "detection", 15, 18), (3, "assembly", 18, 21)]

#: F7: the files of a book, as (rel, mod): the file is there unless the part's key is a multiple of mod.
FILE_KINDS = [(".doc.json", 19), ("body/all_pages.txt", 5), ("full/all_pages.txt", 7), ("body/pages.jsonl", 4), (".pdf", 6), ("_frontmatter.pdf", 2)]
_KINDS = ", ".join(f"('{rel}', {mod})" for rel, mod in FILE_KINDS)
_FOLDER = "CASE WHEN p_partkey % 10 = 9 THEN 'book' ELSE 'e' END || cast(p_partkey AS varchar(12))"
#: F7 for both engines: path and size of the files below /native and /scanned, and the sidecars of folders.
LISTING_SQL = f"""SELECT '/' || tree || '/' || {_FOLDER} || '/' || CASE WHEN rel LIKE '%/%' THEN rel ELSE cast(p_partkey AS varchar(12)) || rel END AS path, cast(p_partkey * 37 % 9000 AS bigint) AS size
    FROM part, (VALUES {_KINDS}) k(rel, mod), (VALUES ('native', 3), ('scanned', 2)) t(tree, every) WHERE p_partkey % mod <> 0 AND p_partkey % every = 0"""
SIDECAR_SQL = f"SELECT '/' || tree || '/' || {_FOLDER} AS folder, cast(p_partkey AS bigint) AS edition, CASE WHEN p_partkey % 14 = 0 THEN 's' || cast(p_partkey AS varchar(12)) END AS pub_id FROM part, (VALUES ('native', 3), ('scanned', 2)) t(tree, every) WHERE p_partkey % every = 0 AND p_partkey % 20 IN (9, 10)"
DUCK_LISTING = f"files AS MATERIALIZED ({LISTING_SQL}), sidecar AS ({SIDECAR_SQL})"


def _from_part(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql.replace("FROM part,", "FROM {part},"), part=read(spark, sf_dir, "part"))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the files of books, path and size."""
    return _from_part(spark, sf_dir, LISTING_SQL)


def sidecars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """what the sidecars of some folders say: edition and public id."""
    return _from_part(spark, sf_dir, SIDECAR_SQL)
