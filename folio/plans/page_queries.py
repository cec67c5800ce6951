"""Queries over page files: names, swaps, printed numbers, order."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import pages as P
from ..sources.tables import DUCK_FILES, page_files, read

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES["q_" + f.__name__] = f
        if oracle is not None:
            ORACLES["q_" + f.__name__] = oracle
        return f

    return add


PF = f"WITH {DUCK_FILES}"
NUM = r"try_cast(nullif(regexp_extract(name, '(\d+)\s*(\.[^.]*)?$', 1), '') AS bigint)"


@query(f"{PF} SELECT book, name, row_number() OVER (PARTITION BY book ORDER BY {NUM}, name) AS pos FROM pf")
def natural_sort(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("book").orderBy(P.natural_key(F.col("name")), "name")
    return page_files(spark, sf_dir).select("book", "name", F.row_number().over(w).cast("long").alias("pos"))


@query(f"""{PF}, w AS (SELECT *, {NUM} AS num, length(cast(max({NUM}) OVER (PARTITION BY book) AS varchar)) AS width FROM pf)
SELECT book, name, regexp_extract(name, '^(.*?)(\\d+)\\s*(\\.[^.]*)?$', 1) || lpad(cast(num AS varchar), cast(greatest(width, length(cast(num AS varchar))) AS int), '0') || '.jpg' AS new_name FROM w""")
def pad_names(spark, sf_dir):
    return P.pad(page_files(spark, sf_dir)).select("book", "name", "new_name")


@query(f"""{PF}, d AS (SELECT DISTINCT book, regexp_extract(name, '^(.*?)\\d+(\\.[^.]*)?$', 1) AS prefix, '.jpg' AS ext, length(regexp_extract(name, '(\\d+)(\\.[^.]*)?$', 1)) AS w FROM pf)
SELECT book, prefix, ext, string_agg(cast(w AS varchar), ',' ORDER BY w) AS widths, count(*) AS n FROM d GROUP BY book, prefix, ext HAVING count(*) > 1""")
def width_groups(spark, sf_dir):
    return P.uneven_widths(page_files(spark, sf_dir))


@query(f"""{PF}, m AS (SELECT *, max(file_idx) OVER (PARTITION BY book) AS last FROM pf),
s AS (SELECT *, file_idx + CASE WHEN (file_idx - 2) % 2 = 0 THEN 1 ELSE -1 END AS p FROM m)
SELECT s.book AS book, s.file_idx AS file_idx, s.name AS name, coalesce(o.name, s.name) AS new_name FROM s LEFT JOIN pf o ON o.book = s.book AND o.file_idx = s.p AND s.file_idx >= 2 AND s.p <= s.last""")
def swap_plan(spark, sf_dir):
    return P.swap_plan(page_files(spark, sf_dir).select("book", "file_idx", "name"), 2)


@query(f"{PF} SELECT book, name FROM pf WHERE {NUM} BETWEEN 3 AND 9")
def rotate_window(spark, sf_dir):
    return page_files(spark, sf_dir).filter(P.page_number(F.col("name")).between(3, 9)).select("book", "name")


@query("""WITH s AS (SELECT c_custkey AS book, unnest(range(1 + c_custkey % 3, 4 + c_custkey % 5)) AS page FROM customer UNION ALL SELECT c_custkey, 20 + c_custkey % 7 FROM customer) SELECT book, cast(page AS int) AS page FROM s""")
def page_list(spark, sf_dir):
    c = F.col("c_custkey")
    spec = F.concat(1 + c % 3, F.lit("-"), F.greatest(3 + c % 5, 1 + c % 3), F.lit(","), 20 + c % 7)
    return P.expand_pages(read(spark, sf_dir, "customer").select(c.alias("book"), spec.alias("spec")))


@query("SELECT cast(n AS bigint) AS n, CASE WHEN n < 26 THEN chr(cast(97 + n AS int)) WHEN n < 702 THEN chr(cast(96 + n // 26 AS int)) || chr(cast(97 + n % 26 AS int)) ELSE chr(cast(97 + (n - 702) // 676 AS int)) || chr(cast(97 + (n - 702) // 26 % 26 AS int)) || chr(cast(97 + (n - 702) % 26 AS int)) END AS label FROM range(18278) t(n)")
def add_labels(spark, sf_dir):
    return spark.range(18278).select(F.col("id").alias("n"), P.letters(F.col("id")).alias("label"))


@query(f"{PF} SELECT book, name, content FROM pf QUALIFY row_number() OVER (PARTITION BY book, content ORDER BY length(regexp_extract(name, '(\\d+)(\\.[^.]*)?$', 1)) DESC, name) = 1")
def dedupe_added(spark, sf_dir):
    return P.dedupe_added(page_files(spark, sf_dir).withColumn("sha", F.sha2("content", 256))).select("book", "name", "content")


ROMANS = " || ".join(f"repeat('{s}', cast({e} AS int))" for s, e in (("M", "v // 1000"),)) + "".join(
    f" || CASE WHEN {d} = 9 THEN '{one}{ten}' WHEN {d} >= 5 THEN '{five}' || repeat('{one}', cast({d} - 5 AS int)) WHEN {d} = 4 THEN '{one}{five}' ELSE repeat('{one}', cast({d} AS int)) END"
    for d, one, five, ten in (("(v // 100 % 10)", "C", "D", "M"), ("(v // 10 % 10)", "X", "L", "C"), ("(v % 10)", "I", "V", "X"))
)


@query(f"SELECT cast(v AS int) AS val, {ROMANS} AS roman FROM range(1, 4000) t(v)")
def roman(spark, sf_dir):
    return P.roman_table(spark)


def _heads(spark, sf_dir):
    f = page_files(spark, sf_dir)
    r = P.roman_table(spark).select(F.col("val").cast("long").alias("printed"), "roman")
    f = f.join(F.broadcast(r), "printed", "left")
    shown = F.when(F.col("kind") == "roman", F.lower("roman")).otherwise(F.col("printed").cast("string"))
    head = F.when(F.col("kind").isNull(), F.lit("Sample")).when(F.col("file_idx") % 2 == 0, F.concat(shown, F.lit(" / Sample"))).otherwise(F.concat(F.lit("Sample Introduction / "), shown))
    return f.select("book", "file_idx", head.alias("head"))


@query(f"{PF} SELECT book, file_idx, CASE WHEN kind = 'roman' AND printed < 1 THEN NULL ELSE kind END AS kind, cast(CASE WHEN kind = 'roman' AND printed < 1 THEN NULL WHEN kind IS NOT NULL THEN printed END AS int) AS val FROM pf")
def running_head_parse(spark, sf_dir):
    return P.parse_heads(_heads(spark, sf_dir), P.roman_table(spark))


@query(f"""{PF}, r AS (SELECT *, CASE WHEN kind IS NOT NULL THEN row_number() OVER (PARTITION BY book, kind, printed ORDER BY file_idx) END AS rep FROM pf),
o AS (SELECT *, CASE WHEN rep = 1 THEN CASE WHEN kind = 'arabic' THEN 100000 ELSE 0 END + printed END AS own FROM r WHERE coalesce(rep, 1) = 1 OR rep IS NULL),
a AS (SELECT *, last_value(own IGNORE NULLS) OVER (PARTITION BY book ORDER BY file_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS anchor FROM o)
SELECT book, name, row_number() OVER (PARTITION BY book ORDER BY anchor IS NOT NULL, anchor, own IS NULL, file_idx) AS seq FROM a""")
def descramble_plan(spark, sf_dir):
    return P.descramble(page_files(spark, sf_dir)).select("book", "name", F.col("seq").cast("long").alias("seq"))


@query(f"""{PF}, n AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY file_idx) AS i FROM pf WHERE kind IS NOT NULL),
d AS (SELECT a.book, a.file_idx, min(abs(a.printed - b.printed)) AS distance FROM n a LEFT JOIN n b ON a.book = b.book AND a.kind = b.kind AND b.i <> a.i AND b.i BETWEEN a.i - 5 AND a.i + 5 GROUP BY a.book, a.file_idx)
SELECT book, file_idx, distance FROM d WHERE distance > 10""")
def flag_suspects(spark, sf_dir):
    return P.suspects(page_files(spark, sf_dir)).filter("suspect").select("book", "file_idx", "distance")


@query(f"""{PF}, w AS (SELECT *, last_value(CASE WHEN kind IS NOT NULL THEN file_idx END IGNORE NULLS) OVER p AS pi, last_value(CASE WHEN kind IS NOT NULL THEN printed END IGNORE NULLS) OVER p AS pv, last_value(kind IGNORE NULLS) OVER p AS pk,
    first_value(CASE WHEN kind IS NOT NULL THEN printed END IGNORE NULLS) OVER f AS nv, first_value(kind IGNORE NULLS) OVER f AS nk
    FROM pf WINDOW p AS (PARTITION BY book ORDER BY file_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY book ORDER BY file_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT book, file_idx, pk AS inferred_kind, pv + file_idx - pi AS inferred FROM w WHERE kind IS NULL AND pi IS NOT NULL AND (nv IS NULL OR (nk = pk AND pv + file_idx - pi < nv))""")
def infer_missing(spark, sf_dir):
    return P.infer_missing(page_files(spark, sf_dir)).filter("inferred IS NOT NULL").select("book", "file_idx", "inferred_kind", "inferred")


@query(f"{PF}, l AS (SELECT *, lag(printed) OVER (PARTITION BY book, kind ORDER BY file_idx) AS before FROM pf WHERE kind IS NOT NULL) SELECT book, file_idx, printed, before FROM l WHERE printed <= before")
def verify_increasing(spark, sf_dir):
    return P.not_rising(page_files(spark, sf_dir)).select("book", "file_idx", "printed", "before")


@query(rf"{PF} SELECT book, name, coalesce(try_cast(nullif(regexp_extract(regexp_replace(name, '\.[^.]*$', ''), '(\d+)\D*$', 1), '') AS bigint), nullif(hk, 0), file_idx) AS page_no FROM pf")
def page_no(spark, sf_dir):
    f = page_files(spark, sf_dir)
    return f.select("book", "name", P.page_no(F.col("name"), F.col("hk").cast("long"), F.col("file_idx")).alias("page_no"))


@query(f"""{PF}, ad AS (SELECT book, file_idx AS after, hk AS ord, 'new-' || (o_orderkey % 40) AS content FROM pf WHERE hk IN (1, 4, 6)),
on1 AS (SELECT * FROM ad QUALIFY row_number() OVER (PARTITION BY book, content ORDER BY after, ord) = 1),
nu AS (SELECT *, row_number() OVER (PARTITION BY book, after ORDER BY ord) - 1 AS n FROM on1)
SELECT nu.book AS book, after, replace(name, '.jpg', '') || chr(cast(97 + n AS int)) || '.jpg' AS new_name FROM nu JOIN pf ON pf.book = nu.book AND pf.file_idx = nu.after""")
def add_pages(spark, sf_dir):
    f = page_files(spark, sf_dir).withColumn("sha", F.sha2("content", 256))
    added = f.filter("hk IN (1, 4, 6)").select("book", F.col("file_idx").alias("after"), F.col("hk").alias("ord"), F.sha2(F.concat(F.lit("new-"), F.col("o_orderkey") % 40), 256).alias("sha"))
    return P.add_pages(f, added).select("book", "after", "new_name")


@query(f"""{PF}, s AS (SELECT DISTINCT book, CASE book % 3 WHEN 0 THEN 'Book - 004.jpg' WHEN 1 THEN 'Book - 5' ELSE '6' END AS start FROM pf),
h AS (SELECT pf.book, start, file_idx, CASE WHEN name = start THEN 0 WHEN replace(name, '.jpg', '') = start THEN 1 WHEN {NUM} = try_cast(start AS bigint) THEN 2 END AS how FROM pf JOIN s ON pf.book = s.book)
SELECT book, start, arg_min(file_idx, (how, file_idx)) AS file_idx FROM h WHERE how IS NOT NULL GROUP BY book, start""")
def start_page(spark, sf_dir):
    f = page_files(spark, sf_dir)
    start = F.when(F.col("book") % 3 == 0, "Book - 004.jpg").when(F.col("book") % 3 == 1, "Book - 5").otherwise("6")
    return P.resolve_start(f.select("book", "file_idx", "name"), f.select("book", start.alias("start")).distinct())


def _strips(spark, sf_dir):
    f = page_files(spark, sf_dir)
    side = lambda name, cond: f.select("book", "file_idx", F.lit(name).alias("side"), F.when(F.expr(cond), F.col("printed")).alias("val"))
    return side("top", "(o_orderkey + book) % 4 <> 0").unionByName(side("bottom", "(o_orderkey + book) % 3 <> 0"))


STRIPS = f"""{PF}, st AS (SELECT book, file_idx, 'top' AS side, CASE WHEN (o_orderkey + book) % 4 <> 0 THEN printed END AS val FROM pf UNION ALL SELECT book, file_idx, 'bottom', CASE WHEN (o_orderkey + book) % 3 <> 0 THEN printed END FROM pf),
nn AS (SELECT book, max(file_idx) AS n, least(max(file_idx), 16) AS k FROM st GROUP BY book),
pl AS (SELECT DISTINCT book, 1 + cast(round_even(cast(i * (n - 1) AS double) / greatest(k - 1, 1), 0) AS bigint) AS file_idx FROM (SELECT *, unnest(range(k)) AS i FROM nn)),
sm AS (SELECT st.* FROM st JOIN pl ON st.book = pl.book AND st.file_idx = pl.file_idx),
bs AS (SELECT book, CASE WHEN count(val) FILTER (side = 'bottom') > count(val) FILTER (side = 'top') THEN 'bottom' ELSE 'top' END AS side FROM sm GROUP BY book)"""


@query(f"{STRIPS} SELECT book, side FROM bs")
def number_side(spark, sf_dir):
    return P.better_side(_strips(spark, sf_dir))


@query(f"{STRIPS} SELECT st.book AS book, file_idx, coalesce(max(val) FILTER (st.side = bs.side), max(val) FILTER (st.side <> bs.side)) AS val FROM st JOIN bs ON st.book = bs.book GROUP BY st.book, file_idx")
def page_values(spark, sf_dir):
    return P.page_values(_strips(spark, sf_dir))


@query()
def unscramble(spark, sf_dir):
    return P.unscramble(page_files(spark, sf_dir))
