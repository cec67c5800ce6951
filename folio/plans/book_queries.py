"""Queries over books as folders of files, and over documents that are read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import books as B
from ..operators import corpus as C
from ..operators import pages as P
from ..operators import structure as S
from ..sources.tables import DUCK_BLK, DUCK_CORPUS, DUCK_FILES, DUCK_HOLDING, DUCK_LISTING, blocks, corpus, holdings, listing, page_files, read, sidecars
from . import docbuild as D
from .block_queries import TYPED

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES["q_" + f.__name__] = f
        if oracle is not None:
            ORACLES["q_" + f.__name__] = oracle
        return f

    return add


FO = f"""WITH {DUCK_LISTING}, fo AS (SELECT regexp_replace(path, '(/(body|full))?/[^/]*$', '') AS folder, min(path) FILTER (path LIKE '%.doc.json') AS doc_json, min(path) FILTER (path LIKE '%/body/all_pages.txt') AS body_text,
    min(path) FILTER (path LIKE '%/full/all_pages.txt') AS full_text, min(path) FILTER (path LIKE '%/body/pages.jsonl') AS pages_jsonl, min(path) FILTER (path LIKE '%.pdf') AS pdf,
    min(path) FILTER (path LIKE '%.pdf' AND path NOT LIKE '%\\_frontmatter.pdf' ESCAPE '\\') AS final_pdf FROM files GROUP BY 1),
idd AS (SELECT fo.*, coalesce(s.edition, try_cast(nullif(regexp_extract(fo.folder, '/e(\\d+)$', 1), '') AS bigint)) AS edition, s.pub_id AS pub_hint FROM fo LEFT JOIN sidecar s ON s.folder = fo.folder)"""


def _folders(spark, sf_dir):
    return B.folders(listing(spark, sf_dir))


@query(f"{FO} SELECT * FROM fo")
def book_folders(spark, sf_dir):
    return _folders(spark, sf_dir)


@query(f"{FO} SELECT edition, max(folder) AS folder FROM idd WHERE doc_json IS NOT NULL AND edition IS NOT NULL GROUP BY edition")
def edition_dirs(spark, sf_dir):
    return B.editions(_folders(spark, sf_dir), sidecars(spark, sf_dir)).select("edition", "folder")


HELD = f"SELECT '/h/' || l_partkey || '/' || l_suppkey || CASE WHEN l_suppkey % 3 = 0 THEN '.PDF' WHEN l_suppkey % 3 = 1 THEN '.pdf' ELSE '.epub' END AS path, cast(l_partkey * l_suppkey % 9000 AS bigint) AS size, l_partkey AS edition_id FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)"


@query(f"WITH f AS ({HELD}) SELECT edition_id, min(path) AS path FROM f WHERE (path LIKE '%.pdf' OR path LIKE '%.PDF') AND size > 4096 GROUP BY edition_id")
def holding_path(spark, sf_dir):
    f = spark.sql(HELD.replace("FROM lineitem", "FROM {lineitem}"), lineitem=read(spark, sf_dir, "lineitem"))
    return B.holding_paths(f.select("edition_id", F.col("path").alias("file_path")), f.select("path", "size"))


LINES = "SELECT '/out/b' || (o_custkey % 200) || '/' || (o_custkey % 3) || '.doc.json' AS doc_json, o_orderkey AS line FROM orders"


@query(f"WITH m AS ({LINES}) SELECT regexp_replace(doc_json, '/[^/]*$', '') AS folder, min(line) AS pos FROM m GROUP BY 1")
def book_dirs(spark, sf_dir):
    m = spark.sql(LINES.replace("FROM orders", "FROM {orders}"), orders=read(spark, sf_dir, "orders"))
    return B.book_dirs(m, _folders(spark, sf_dir))


@query(f"{FO} SELECT folder, CASE WHEN folder LIKE '/scanned/%' THEN 0 ELSE 1 END AS pos FROM fo WHERE doc_json IS NOT NULL")
def book_dirs_scan(spark, sf_dir):
    return B.book_dirs(None, _folders(spark, sf_dir), ("/scanned", "/native"))


INPUTS = "SELECT p_partkey AS ord, CASE p_partkey % 4 WHEN 0 THEN '/in/' || p_partkey || '.pdf' WHEN 1 THEN '/in/' || p_partkey || '.list' WHEN 2 THEN '/native/e' || p_partkey ELSE '/gone/' || p_partkey END AS path FROM part"
WORK = "SELECT '/in/' || p_partkey || '.list' AS path, n AS no, CASE n WHEN 0 THEN '# books' WHEN 1 THEN '  ' WHEN 2 THEN ' /a/' || p_partkey || ' ' ELSE '/b/' || p_partkey END AS line FROM part, (VALUES (0), (1), (2), (3)) t(n)"


@query(f"""WITH {DUCK_LISTING}, i AS ({INPUTS}), w AS ({WORK}), d AS (SELECT regexp_replace(path, '/[^/]*$', '') AS path, path AS source FROM files WHERE path LIKE '%.pdf')
SELECT ord, 0 AS sub, path AS source FROM i WHERE path LIKE '%.pdf' UNION ALL SELECT ord, no, trim(line) FROM i JOIN w ON i.path = w.path WHERE trim(line) <> '' AND line NOT LIKE '#%'
UNION ALL SELECT ord, 0, coalesce(source, i.path) FROM i LEFT JOIN d ON d.path = i.path WHERE i.path NOT LIKE '%.pdf' AND i.path NOT LIKE '%.list'""")
def resolve_inputs(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    sql = lambda q: spark.sql(q.replace("FROM part", "FROM {part}"), part=part)
    return B.resolve_inputs(sql(INPUTS), listing(spark, sf_dir), sql(WORK))


HEALTH = "edition, n_blocks, cache_pages AS n_pages, schema_version IS NOT NULL AND n_blocks <> 0 AS ok"


def _health(spark, sf_dir):
    h = C.health(corpus(spark, sf_dir).withColumn("n_pages", F.col("cache_pages")))
    ids = B.identified(_folders(spark, sf_dir), sidecars(spark, sf_dir)).select("folder", "edition")
    return ids.join(h.select("edition", "ok", "reasons", "n_blocks", "n_pages"), "edition")


@query(f"{FO}, {DUCK_CORPUS} SELECT folder, final_pdf IS NOT NULL AND coalesce(cache_pages <> 0 AND schema_version IS NOT NULL AND n_blocks <> 0, false) AS done FROM idd LEFT JOIN corpus c ON c.edition = idd.edition")
def is_done(spark, sf_dir):
    return B.is_done(_folders(spark, sf_dir), _health(spark, sf_dir)).select("folder", "done")


@query(f"{FO}, {DUCK_CORPUS}, h AS (SELECT folder, cache_pages <> 0 AND schema_version IS NOT NULL AND n_blocks <> 0 AS ok FROM idd JOIN corpus c ON c.edition = idd.edition) SELECT folder, folder || CASE WHEN ok THEN '/.ocr_ok' ELSE '/.ocr_incomplete' END AS path, folder || CASE WHEN ok THEN '/.ocr_incomplete' ELSE '/.ocr_ok' END AS clear FROM h")
def markers(spark, sf_dir):
    return B.markers(_health(spark, sf_dir)).select("folder", "path", "clear")


CACHES = "CASE p_partkey % 6 WHEN 0 THEN '{}' WHEN 1 THEN '{\"1\": []}' WHEN 2 THEN '[1]' WHEN 3 THEN '{\"1\": ' WHEN 4 THEN NULL ELSE '{\"a\": {\"b\": 1}, \"c\": 2}' END"


@query("SELECT p_partkey AS edition, p_partkey % 6 IN (1, 5) AS usable FROM part")
def usable_cache(spark, sf_dir):
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("edition"), B.usable_cache(F.expr(CACHES)).alias("usable"))


def _docs(spark, sf_dir):
    ids = B.identified(_folders(spark, sf_dir), sidecars(spark, sf_dir)).filter("doc_json IS NOT NULL").select("folder", "edition")
    source = F.concat(F.lit("/src/"), F.col("edition").cast("string"), F.lit(".pdf"))
    return ids.join(corpus(spark, sf_dir), "edition").select("folder", "doc_id", "title", source.alias("source"), "schema_version", F.array(F.lit("region")).alias("features"), "n_blocks", (F.col("cache_pages") > 0).alias("cached"))


DO = "dc AS (SELECT folder, c.*, '/src/' || c.edition || '.pdf' AS source FROM idd JOIN corpus c ON c.edition = idd.edition WHERE doc_json IS NOT NULL)"


@query(f"""{FO}, {DUCK_CORPUS}, {DO} SELECT regexp_extract(fo.folder, '[^/]*$') AS edition, title, doc_id, source, schema_version, CASE WHEN dc.folder IS NULL THEN '' ELSE 'region' END AS features, coalesce(n_blocks, 0) AS n_blocks, doc_json, pdf, body_text, pages_jsonl
FROM fo LEFT JOIN dc ON dc.folder = fo.folder""")
def ingest_rows(spark, sf_dir):
    return B.ingest_rows(_folders(spark, sf_dir), _docs(spark, sf_dir)).withColumn("features", F.array_join("features", ","))


@query(f"""{FO}, {DUCK_CORPUS}, {DO}, k AS (SELECT *, coalesce(pub_hint, 'e' || edition, regexp_extract(folder, '[^/]*$')) AS key FROM idd WHERE doc_json IS NOT NULL)
SELECT key, k.pub_hint AS pub_id, coalesce('e' || k.edition, regexp_extract(k.folder, '[^/]*$')) AS edition, doc_id, title, CASE WHEN cache_pages > 0 THEN 'scanned' ELSE 'native' END AS kind, source, schema_version, key || '/' || regexp_extract(doc_json, '[^/]*$') AS doc_json,
    CASE WHEN body_text IS NOT NULL THEN key || '/body/all_pages.txt' END AS body_text, CASE WHEN full_text IS NOT NULL THEN key || '/full/all_pages.txt' END AS full_text, CASE WHEN pages_jsonl IS NOT NULL THEN key || '/body/pages.jsonl' END AS pages_jsonl, coalesce(n_blocks, 0) AS n_blocks, true AS nfc
FROM k LEFT JOIN dc ON dc.folder = k.folder""")
def corpus_rows(spark, sf_dir):
    return B.corpus_rows(_folders(spark, sf_dir), sidecars(spark, sf_dir), _docs(spark, sf_dir), strict=False)


@query(f"""{FO}, {DUCK_CORPUS}, {DUCK_HOLDING}, {DO}, n AS (SELECT * FROM idd WHERE folder LIKE '/native/%' AND doc_json IS NOT NULL AND edition IS NOT NULL), s AS (SELECT * FROM idd WHERE folder LIKE '/scanned/%' AND doc_json IS NOT NULL AND edition IS NOT NULL),
r AS (SELECT *, 'native' AS kind FROM n UNION ALL SELECT *, 'scanned' FROM s WHERE edition NOT IN (SELECT edition FROM n)), h AS (SELECT edition_id, max(pub_id) AS pub_id, min(content_hash) AS sole, count(*) AS files FROM holding GROUP BY edition_id)
SELECT r.edition AS edition, kind, title, coalesce(h.pub_id, r.pub_hint) AS pub_id, CASE WHEN h.pub_id IS NOT NULL AND files = 1 THEN sole END AS content_hash, body_text IS NOT NULL AS complete
FROM r LEFT JOIN dc ON dc.folder = r.folder LEFT JOIN h ON h.edition_id = r.edition""")
def hand_off(spark, sf_dir):
    f = _folders(spark, sf_dir)
    native, scanned = (B.editions(f.filter(F.col("folder").startswith(t)), sidecars(spark, sf_dir)) for t in ("/native/", "/scanned/"))
    return B.hand_off(native, scanned, _docs(spark, sf_dir), holdings(spark, sf_dir)).select("edition", "kind", "title", "pub_id", "content_hash", "complete")


STATE = "cast(edition AS string) AS book, edition % 11 = 0 AS done, edition % 7 = 0 AS active, schema_version IS NOT NULL AND n_blocks <> 0 AS ok, cache_pages AS cached"


@query(f"WITH {DUCK_CORPUS} SELECT cast(edition AS varchar) AS book, cache_pages AS cached, CASE WHEN schema_version IS NOT NULL AND n_blocks <> 0 THEN 'resume' ELSE 'broken' END AS state FROM corpus WHERE edition % 11 <> 0 AND edition % 7 <> 0 AND (NOT (schema_version IS NOT NULL AND n_blocks <> 0) OR cache_pages > 0)")
def resumable(spark, sf_dir):
    return B.resumable(C.book_state(corpus(spark, sf_dir).selectExpr(*STATE.split(", ")))).select("book", "cached", "state")


@query(f"""WITH {DUCK_FILES}, i AS (SELECT '/img/' || book AS source, count(*) AS n FROM pf GROUP BY book), s AS (SELECT '/img/' || c_custkey AS source, CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 500 END AS pdf_pages FROM customer)
SELECT s.source AS source, cast(coalesce(n, least(pdf_pages, 300), 0) AS bigint) AS pages FROM s LEFT JOIN i ON i.source = s.source""")
def count_pages(spark, sf_dir):
    f = page_files(spark, sf_dir).select(F.concat(F.lit("/img/"), "book", F.lit("/"), "name").alias("path"))
    s = read(spark, sf_dir, "customer").select(F.concat(F.lit("/img/"), "c_custkey").alias("source"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey") % 500).alias("pdf_pages"))
    return B.count_pages(s, f, 300)


NAMES = "CASE WHEN p_partkey % 50 = 0 THEN '??' ELSE '_ ' || p_name || ' (v' || p_partkey || ').é' END"


@query(f"SELECT p_partkey AS edition, trim(regexp_replace({NAMES}, '[^A-Za-z0-9._-]+', '_', 'g'), '_') AS safe, coalesce(nullif(trim(regexp_replace({NAMES}, '[^A-Za-z0-9._-]+', '_', 'g'), '_'), ''), 'job') AS slug FROM part")
def slug(spark, sf_dir):
    name = F.expr(NAMES)
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("edition"), T.safe_name(name).alias("safe"), T.slug(name).alias("slug"))


SHEETS = "p_partkey AS base, 'png' AS ext, 600 + p_partkey % 700 AS w, 800 AS h, CASE WHEN p_partkey % 5 <> 0 THEN 300 + p_partkey % 90 END AS split"


@query(f"WITH s AS (SELECT {SHEETS} FROM part) SELECT base, base || s.side || '.png' AS name, cast(CASE WHEN s.side = 'b' THEN split ELSE 0 END AS int) AS x0, cast(CASE WHEN s.side = 'a' THEN split ELSE w END AS int) AS x1 FROM (SELECT *, unnest(CASE WHEN w * 100 >= 115 * h AND split IS NOT NULL THEN ['a', 'b'] ELSE [''] END) AS side FROM s) s")
def rendered(spark, sf_dir):
    return B.rendered(read(spark, sf_dir, "part").selectExpr(*SHEETS.split(", ")))


CUTS = "CASE p_partkey % 3 WHEN 0 THEN array(50) WHEN 1 THEN array(33, 66) ELSE array(1, 60) END"


@query("WITH s AS (SELECT cast(p_partkey AS varchar) AS stem, unnest(CASE p_partkey % 3 WHEN 0 THEN [(0, 0, 50), (1, 50, 100)] WHEN 1 THEN [(0, 0, 33), (1, 33, 66), (2, 66, 100)] ELSE [(1, 1, 60), (2, 60, 100)] END) AS b FROM part) SELECT stem, stem || '__c' || b[1] AS strip, b[2] AS x0, b[3] AS x1 FROM s")
def strips(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    return B.strips(part.select(F.col("p_partkey").cast("string").alias("stem"), F.lit(100).alias("w"), F.expr(CUTS).alias("cuts")))


@query("""WITH p AS (SELECT p_partkey, p_name || ' ' || p_type AS text, p_partkey % 4 AS boxes FROM part), w AS (SELECT p_partkey, boxes, unnest(range(len(l))) AS pos, unnest(l) AS word FROM (SELECT *, string_split(text, ' ') AS l FROM p)),
c AS (SELECT *, sum(length(word) + 1) OVER (PARTITION BY p_partkey ORDER BY pos) - length(word) - 1 AS before, sum(length(word) + 1) OVER (PARTITION BY p_partkey) AS total FROM w),
d AS (SELECT *, CASE WHEN boxes = 0 THEN 0 ELSE 1 + (SELECT count(*) FROM range(1, 4) t(i) WHERE i <= boxes AND before * boxes * (boxes + 1) >= i * (i + 1) * total) END AS box FROM c)
SELECT p_partkey AS block, cast(box AS bigint) AS box, string_agg(word, ' ' ORDER BY pos) AS line FROM d GROUP BY p_partkey, box""")
def line_texts(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    b = part.select(F.col("p_partkey").alias("block"), F.concat_ws(" ", "p_name", "p_type").alias("text"))
    boxes = part.select(F.col("p_partkey").alias("block"), F.explode(F.expr("CASE WHEN p_partkey % 4 > 0 THEN sequence(1L, p_partkey % 4) END")).alias("box"))
    return B.line_texts(b, boxes.selectExpr("block", "box", "10 * box AS y", "100 * box AS width"), ["block"])


@query(f"""WITH {DUCK_FILES}, a AS (SELECT DISTINCT book, CASE book % 4 WHEN 0 THEN 'x/3.jpg' WHEN 1 THEN 'cover.jpg' WHEN 2 THEN 'p3.jpg' ELSE 'p9999.jpg' END AS anchor FROM pf),
m AS (SELECT book, name FROM pf WHERE cast(regexp_extract(name, '(\\d+)\\.', 1) AS bigint) = 3)
SELECT a.book AS book, anchor, CASE WHEN m.book IS NOT NULL THEN 'Book - ' END AS prefix, length(regexp_extract(m.name, '(\\d+)\\.', 1)) AS width, CASE WHEN m.book IS NOT NULL THEN 3::bigint END AS number,
    CASE WHEN a.book % 4 = 0 THEN 'a path' WHEN a.book % 4 = 1 THEN 'no page number' WHEN a.book % 4 = 3 THEN 'no such page, near it: ' WHEN m.book IS NULL THEN 'no such page, near it: ' || coalesce((SELECT string_agg(DISTINCT n, ',' ORDER BY n) FROM (SELECT book, cast(regexp_extract(name, '(\\d+)\\.', 1) AS bigint) AS n FROM pf) q WHERE q.book = a.book AND n <= 6), '') END AS error
FROM a LEFT JOIN m ON m.book = a.book AND a.book % 4 = 2""")
def anchors(spark, sf_dir):
    f = page_files(spark, sf_dir)
    a = F.when(F.col("book") % 4 == 0, "x/3.jpg").when(F.col("book") % 4 == 1, "cover.jpg").when(F.col("book") % 4 == 2, "p3.jpg").otherwise("p9999.jpg")
    return P.resolve_anchor(f, f.select("book", a.alias("anchor")).distinct(), strict=False)


KEY = ["doc_id", "page_idx", "block_idx"]


@query(f"{TYPED} SELECT doc_id, page_idx, block_idx FROM ty WHERE coalesce(region, 'body') = 'body' AND type IN ('body', 'heading', 'verse') AND type NOT IN ('verse') AND chapter = '3'")
def iter_blocks(spark, sf_dir):
    return D.iter_blocks(S.typed(blocks(spark, sf_dir)), region="body", types=["body", "heading", "verse"], exclude_types=["verse"], chapter="3").select(*KEY)


@query(f"{TYPED} SELECT doc_id, page_idx, block_idx, type FROM ty WHERE type = 'heading'")
def headings(spark, sf_dir):
    return D.headings(S.typed(blocks(spark, sf_dir))).select(*KEY, "type")


def _reread(spark, sf_dir):
    t = S.typed(blocks(spark, sf_dir))
    b = F.sort_array(F.collect_list(F.struct("page_idx", "seq", F.struct("id", "type", "text", F.col("page_idx").alias("page"), F.when(F.col("region") != "body", F.col("region")).alias("region")).alias("b"))))
    docs = t.groupBy("doc_id").agg(F.transform(b, lambda x: x["b"]).alias("blocks"))
    features = F.when(F.col("doc_id") % 3 != 0, F.array(F.lit("region")))
    texts = docs.select(F.to_json(F.struct(F.col("doc_id").cast("string").alias("doc_id"), features.alias("features"), "blocks")).alias("json"))
    return D.open_docs(texts.unionByName(spark.createDataFrame([('{"doc_id": "broken", "blo',)], "json string")))


@query(f"{TYPED} SELECT cast(doc_id AS varchar) AS doc_id, '0' AS schema_version, id, type, text, cast(page_idx AS bigint) AS page, coalesce(region, 'body') AS region FROM ty")
def open_docs(spark, sf_dir):
    return _reread(spark, sf_dir).select("doc_id", "schema_version", "id", "type", "text", "page", "region")


FURNITURE = "'page_header', 'page_footer', 'page_number', 'running_head', 'title_page', 'copyright', 'colophon', 'dedication', 'toc', 'footnote', 'endnote'"


@query(f"{TYPED} SELECT cast(doc_id AS varchar) AS doc_id, id, doc_id % 3 <> 0 AS declared FROM ty WHERE type NOT IN ({FURNITURE}) AND (doc_id % 3 = 0 OR coalesce(region, 'body') = 'body')")
def content_by_feature(spark, sf_dir):
    b = _reread(spark, sf_dir)
    return D.content_blocks(b).select("doc_id", "id", D.has_feature(b, "region").alias("declared"))


@query(f"{TYPED} SELECT doc_id, count(*) AS n_blocks FROM ty GROUP BY doc_id")
def doc_lengths(spark, sf_dir):
    return D.doc_lengths(S.typed(blocks(spark, sf_dir)))
