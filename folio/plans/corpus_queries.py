"""Queries over corpus rows and over the state of work."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import corpus as C
from ..sources.tables import DUCK_CORPUS, DUCK_FILES, DUCK_HOLDING, corpus, holdings, page_files, read

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES["q_" + f.__name__] = f
        if oracle is not None:
            ORACLES["q_" + f.__name__] = oracle
        return f

    return add


CO = f"WITH {DUCK_CORPUS}"


def _sides(spark, sf_dir):
    c = corpus(spark, sf_dir)
    cols = ["edition", "doc_id", "title", "n_blocks"]
    return c.filter("native").select(cols), c.filter("scanned").select(cols)


@query(f"{CO} SELECT edition, doc_id, title, n_blocks, CASE WHEN native THEN 'native' ELSE 'scanned' END AS kind FROM corpus WHERE native OR scanned")
def native_wins(spark, sf_dir):
    return C.native_wins(*_sides(spark, sf_dir))


@query(f"{CO} SELECT count(*) AS excluded FROM corpus WHERE native AND scanned")
def dup_excluded(spark, sf_dir):
    native, scanned = _sides(spark, sf_dir)
    return scanned.join(native, "edition", "left_semi").agg(F.count(F.lit(1)).alias("excluded"))


HO = f"{CO}, {DUCK_HOLDING}"


@query(f"{HO} SELECT edition_id AS edition, max(pub_id) AS pub_id, count(content_hash) AS n_hashes FROM holding GROUP BY edition_id")
def catalogue_map(spark, sf_dir):
    return C.catalogue(holdings(spark, sf_dir)).select("edition", "pub_id", "n_hashes")


def _rows(spark, sf_dir):
    h = holdings(spark, sf_dir).groupBy(F.col("edition_id").alias("edition")).agg(F.min_by("file_path", "supp").alias("own"))
    c = corpus(spark, sf_dir).withColumn("at", F.when(F.col("edition") % 5 != 0, F.col("edition")).otherwise(F.col("edition") + 1))
    return c.join(h.withColumnRenamed("edition", "at"), "at", "left").select("edition", F.col("own").alias("source"), "pub_hint")


@query(f"""{HO}, m AS (SELECT edition_id, arg_min(file_path, supp) AS own FROM holding GROUP BY edition_id),
r AS (SELECT c.edition, m.own AS source, pub_hint FROM corpus c LEFT JOIN m ON m.edition_id = CASE WHEN c.edition % 5 <> 0 THEN c.edition ELSE c.edition + 1 END),
k AS (SELECT edition_id, max(pub_id) AS pub_id, count(*) AS n, min(content_hash) AS sole FROM holding GROUP BY edition_id)
SELECT r.edition AS edition, coalesce(k.pub_id, h.pub_id, r.pub_hint) AS stamped,
    CASE WHEN k.pub_id IS NOT NULL THEN coalesce(CASE WHEN h.edition_id = r.edition THEN h.content_hash END, CASE WHEN k.n = 1 THEN k.sole END) ELSE h.content_hash END AS content_hash
FROM r LEFT JOIN k ON k.edition_id = r.edition LEFT JOIN holding h ON h.file_path = r.source""")
def stamp_identity(spark, sf_dir):
    return C.stamp(_rows(spark, sf_dir), holdings(spark, sf_dir)).select("edition", "stamped", "content_hash")


@query(f"{CO} SELECT edition, coalesce(pub_hint, 'e' || edition, 'x') AS key FROM corpus")
def corpus_key(spark, sf_dir):
    return corpus(spark, sf_dir).select("edition", C.corpus_key(F.col("pub_hint"), F.col("edition"), F.lit("x")).alias("key"))


@query(f"""{CO} SELECT edition, array_to_string(list_filter([CASE WHEN cache_pages = 0 THEN 'empty cache' END, CASE WHEN schema_version IS NULL THEN 'no schema_version' END, CASE WHEN n_blocks = 0 THEN 'no blocks' END], lambda x: x IS NOT NULL), ',') AS reasons,
    cache_pages <> 0 AND schema_version IS NOT NULL AND n_blocks <> 0 AS ok FROM corpus""")
def health(spark, sf_dir):
    return C.health(corpus(spark, sf_dir)).select("edition", "reasons", "ok")


@query(f"{CO} SELECT edition, title || CASE WHEN edition % 10 = 0 THEN '-v2' ELSE '' END AS title FROM corpus")
def manifest_upsert(spark, sf_dir):
    c = corpus(spark, sf_dir).select("edition", "title")
    return C.upsert(c, c.filter("edition % 10 = 0").withColumn("title", F.concat("title", F.lit("-v2"))), ["edition"])


MIXED = "CASE WHEN edition % 13 = 0 THEN 'x' || edition ELSE cast(edition AS varchar(12)) END"


@query(f"{CO}, e AS (SELECT {MIXED} AS edition FROM corpus WHERE native) SELECT edition, row_number() OVER (ORDER BY CASE WHEN regexp_full_match(edition, '\\d+') THEN 0 ELSE 1 END, try_cast(edition AS bigint), edition) AS pos FROM e")
def manifest_sort(spark, sf_dir):
    e = corpus(spark, sf_dir).filter("native").selectExpr(f"{MIXED} AS edition")
    return C.manifest_order(e).select("edition", F.col("pos").cast("long").alias("pos"))


RULES = [(1, "edition:50", "columns", "2"), (2, "Rose", "two_up", "auto"), (3, "edition:100", "columns", "3"), (4, "blue", "columns", "2"), (5, "metal", "drop_pages", "even"), (6, "steel", "columns", "1"), (7, "edition:50", "two_up", "off")]
D_RULES = ", ".join(f"({o}, '{k}', '{p}', '{v}')" for o, k, p, v in RULES)


@query(f"""{CO}, r(ord, key, opt, val) AS (VALUES {D_RULES}), h AS (SELECT c.edition, r.* FROM corpus c JOIN r ON CASE WHEN starts_with(key, 'edition:') THEN key = 'edition:' || c.edition ELSE contains(lower(c.title), lower(key)) END)
SELECT edition, opt, arg_max(val, ord) AS val FROM h GROUP BY edition, opt""")
def layout_lookup(spark, sf_dir):
    books = corpus(spark, sf_dir).select("edition", F.col("title").alias("stem"))
    return C.layout_lookup(books, spark.createDataFrame(RULES, "ord int, key string, opt string, val string"))


@query(f"WITH {DUCK_FILES} SELECT book, name FROM pf WHERE hk % 3 = 0 OR cast(o_orderdate AS date) > date '1995-01-01'")
def pending_pages(spark, sf_dir):
    f = page_files(spark, sf_dir)
    images = f.select("book", "name", F.col("o_orderdate").cast("date").alias("mtime"))
    cached = f.filter("hk % 3 <> 0").select("book", "name", F.to_date(F.lit("1995-01-01")).alias("cache_mtime"))
    return C.pending(images, cached).select("book", "name")


@query(f"WITH {DUCK_FILES} SELECT book, name, (file_idx - 1) % 4 AS shard FROM pf")
def stripe(spark, sf_dir):
    return C.stripe(page_files(spark, sf_dir), 4, "file_idx", "book").select("book", "name", F.col("shard").cast("long").alias("shard"))


CLAIM = "s_suppkey AS name, 'h' || (s_nationkey % 3) AS host, s_suppkey % 4 <> 0 AS alive, s_suppkey * 37 % 2000 AS age_s, s_suppkey % 23 = 0 AS corrupt"


@query(f"WITH c AS (SELECT {CLAIM} FROM supplier) SELECT name, CASE WHEN corrupt THEN true WHEN host = 'h1' THEN NOT alive ELSE age_s > 900 END AS stealable FROM c")
def claims_stealable(spark, sf_dir):
    c = read(spark, sf_dir, "supplier").selectExpr(*CLAIM.split(", "))
    return C.stealable(c, "h1", 900).select("name", "stealable")


STATE = "edition, edition % 11 = 0 AS done, edition % 7 = 0 AS active, schema_version IS NOT NULL AND n_blocks <> 0 AS ok, cache_pages AS cached, 3 + edition % 5 AS total"


@query(f"{CO}, b AS (SELECT {STATE} FROM corpus) SELECT edition, CASE WHEN done THEN 'done' WHEN active THEN 'active' WHEN NOT ok THEN 'broken' WHEN cached = 0 THEN 'not-started' ELSE 'resume' END AS state FROM b")
def book_state(spark, sf_dir):
    return C.book_state(corpus(spark, sf_dir).selectExpr(*STATE.split(", "))).select("edition", "state")


@query(f"{CO}, b AS (SELECT {STATE} FROM corpus) SELECT cast(sum(CASE WHEN done THEN total ELSE least(cached, total) END) AS bigint) AS pages_done, cast(sum(total) AS bigint) AS pages, count(*) FILTER (done) AS books_done FROM b")
def progress(spark, sf_dir):
    return C.progress(corpus(spark, sf_dir).selectExpr(*STATE.split(", ")))


@query("""WITH t AS (SELECT l_suppkey % 3 AS log, l_orderkey % 500 AS task, max(cast(floor(l_quantity * 80) AS int)) AS tokens FROM lineitem GROUP BY 1, 2)
SELECT log, count(*) AS tasks, count(*) FILTER (tokens >= 3450) AS hits, array_to_string(list_sort(list(tokens) FILTER (tokens >= 3450), 'DESC'), ',') AS top FROM t GROUP BY log""")
def token_caps(spark, sf_dir):
    t = read(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 3).alias("log"), (F.col("l_orderkey") % 500).alias("task"), F.floor(F.col("l_quantity") * 80).cast("int").alias("tokens"))
    return C.capped(t, 3500)


@query("SELECT o_custkey AS batch, o_orderkey AS book, sum(o_orderkey % 9 + 1) OVER w AS pages_so_far, sum(o_orderkey % 50) OVER w AS seconds_so_far FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
def book_timing(spark, sf_dir):
    t = read(spark, sf_dir, "orders").selectExpr("o_custkey AS batch", "o_orderkey AS book", "o_orderdate AS finish", "o_orderkey % 9 + 1 AS pages", "o_orderkey % 50 AS seconds")
    return C.running_totals(t).select("batch", "book", "pages_so_far", "seconds_so_far")


@query("SELECT doc_id, nfc_normalize(text) = text AS nfc FROM documents")
def nfc_check(spark, sf_dir):
    return C.nfc_share(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "nfc")


CLAIM2 = CLAIM + ", s_suppkey AS pid"


@query(f"WITH c AS (SELECT {CLAIM2} FROM supplier) SELECT name, host, pid, age_s FROM c WHERE NOT CASE WHEN corrupt THEN true WHEN host = 'h1' THEN NOT alive ELSE age_s > 900 END")
def active_claims(spark, sf_dir):
    return C.active_claims(read(spark, sf_dir, "supplier").selectExpr(*CLAIM2.split(", ")), "h1", 900)


@query(f"""WITH c AS (SELECT {CLAIM2} FROM supplier), h AS (SELECT name, pid FROM c WHERE NOT CASE WHEN corrupt THEN true WHEN host = 'h1' THEN NOT alive ELSE age_s > 900 END),
w AS (SELECT l_suppkey AS name, arg_min(l_orderkey, (l_linenumber, l_orderkey)) AS pid FROM lineitem GROUP BY l_suppkey)
SELECT name, pid, false AS won FROM h UNION ALL SELECT name, pid, true FROM w WHERE name NOT IN (SELECT name FROM h)""")
def leases(spark, sf_dir):
    claims = read(spark, sf_dir, "supplier").selectExpr(*CLAIM2.split(", "))
    wanted = read(spark, sf_dir, "lineitem").selectExpr("l_suppkey AS name", "l_orderkey AS pid", "l_linenumber AS asked_at")
    return C.acquire(claims, wanted, "h1", 900)


HELD = "s_suppkey AS name, 'h' || (s_nationkey % 3) AS host, s_suppkey * 3 AS pid, 'old' AS note"
ASKED = "s_suppkey AS name, 'h' || (s_nationkey % 3) AS host, s_suppkey * CASE WHEN s_suppkey % 4 = 0 THEN 5 ELSE 3 END AS pid, 'n' || s_suppkey AS note"


@query(f"SELECT name, host, pid, CASE WHEN name % 5 = 1 AND name % 4 <> 0 THEN 'n' || name ELSE note END AS note FROM (SELECT {HELD} FROM supplier) c")
def claim_update(spark, sf_dir):
    s = read(spark, sf_dir, "supplier")
    claims, asked = (s.selectExpr(*x.split(", ")) for x in (HELD, ASKED))
    return C.update_claims(claims, asked.filter("name % 5 = 1"))


@query(f"SELECT name, host, pid FROM (SELECT {HELD} FROM supplier) c WHERE name % 3 <> 0 OR name % 4 = 0 AND name <> 0")
def claim_release(spark, sf_dir):
    s = read(spark, sf_dir, "supplier")
    claims, asked = (s.selectExpr(*x.split(", ")) for x in (HELD, ASKED))
    return C.release(claims, asked.filter("name % 3 = 0")).select("name", "host", "pid")


LEFT = "c_custkey AS campaign, c_custkey % 50 AS pages_done, c_custkey % 20 AS pages_before, 40 + c_custkey % 7 AS pages, 10 * (c_custkey % 11) AS seconds"


@query(f"SELECT campaign, round(CASE WHEN pages_done > pages_before THEN seconds / (pages_done - pages_before) END, 6) AS s_page, round(CASE WHEN pages_done > pages_before THEN seconds / (pages_done - pages_before) * greatest(pages - pages_done, 0) END, 6) AS seconds_left FROM (SELECT {LEFT} FROM customer) s")
def time_left(spark, sf_dir):
    t = C.time_left(read(spark, sf_dir, "customer").selectExpr(*LEFT.split(", ")))
    return t.select("campaign", F.round("s_page", 6).alias("s_page"), F.round("seconds_left", 6).alias("seconds_left"))
