"""Quality rules (1): base rules, and minimum-covariance-determinant outliers per language and source; DataFrame and SQL only."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, table

#: Share of the rows in the subset whose covariance determinant is made small, and the factor that makes that
#: covariance consistent for four normal variables: 0.75 over the chi-square(6) probability of the 0.75 quantile of chi-square(4).
H, CONSISTENT = 0.75, 1.486
#: Concentration steps from each of the two starts.
STEPS = 4
#: Groups with fewer rows take the estimates of their language; languages with fewer, those of all rows; with fewer in all, nothing is rejected.
LEAST_ROWS = 100
#: Standard deviations, in units of the transformed statistics, that are added to each variance: word length, symbols, repeated lines, repeated words.
FLOORS = (0.05, 0.05, 0.15, 0.08)
#: Squared Mahalanobis distance beyond which a row is rejected: chi-square(4) at 1 - 1e-5.
CUTOFF = 28.5
#: The statistics are whole multiples of 1 / UNIT, so that sums of squares are exact in any order. They end at 64, as sums are 64-bit numbers: e ** 64 characters a word, 4096 symbols a word.
UNIT = 1024
P = 4
#: Parts that the rows of a group are joined in.
SALTS = 16
_PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (all long); null counts as empty.

    Repeated words are found inside the row: the hashes of the five-word windows are sorted with their places,
    neighbours that are equal give the repeated windows, and the sorted places give the words that those cover.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    d = docs.withColumns({"w_": F.filter(F.split(t, SPACE), lambda w: w != ""), "l_": F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    d = d.withColumns(
        {
            "n_words": F.size("w_").cast("long"),
            "word_chars": F.length(F.regexp_replace(t, SPACE, "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long"),
            "n_lines": F.size("l_").cast("long"),
            "n_dup_lines": (F.size("l_") - F.size(F.array_distinct("l_"))).cast("long"),
            "h_": F.transform("w_", lambda w: F.xxhash64(w)),
        }
    ).drop("w_", "l_")
    d = d.withColumn("g_", F.expr("CASE WHEN size(h_) < 5 THEN array() ELSE transform(sequence(1, size(h_) - 4), i -> xxhash64(slice(h_, i, 5))) END")).drop("h_")
    d = d.withColumn("g_", F.expr("CASE WHEN size(array_distinct(g_)) < size(g_) THEN sort_array(transform(g_, (x, i) -> struct(x, i))) END"))
    d = d.withColumn("g_", F.expr("zip_with(g_, slice(g_, 2, size(g_)), (a, b) -> CASE WHEN a.x = b.x THEN array(a.i, b.i) END)"))
    d = d.withColumn("g_", F.expr("sort_array(array_distinct(flatten(filter(g_, x -> x IS NOT NULL))))"))
    gaps = "aggregate(zip_with(g_, slice(g_, 2, size(g_)), (a, b) -> least(5, coalesce(b - a, 5))), 0L, (s, x) -> s + x)"
    return d.withColumn("n_repeat_words", F.coalesce(F.expr(gaps), F.lit(0)).cast("long")).drop("g_")


#: Base rule of rejection, in SQL over the statistics.
BASE_FAILED = "(n_words < 10 OR 100 * n_repeat_words > 20 * n_words)"
_VECTOR = (
    "ln((word_chars + 100) / cast(n_words + 20 AS double))",
    "sqrt(n_symbols / cast(n_words + 20 AS double))",
    "n_dup_lines / cast(n_lines + 5 AS double)",
    "n_repeat_words / cast(n_words + 20 AS double)",
)
VECTOR = [f"cast(round(least({x}, 64.0e0) * {UNIT}) AS bigint) AS x{i}" for i, x in enumerate(_VECTOR)]


def mcd_sql(stats: str, percentile: str, salts: str, prefix: str = "") -> list[tuple[str, str]]:
    """Named queries, each over those before it, of which the last (far) gives the columns of stats with d2: each row's squared distance from the estimates of its language and source.

    stats has lang, source, x0..x3 and the statistics; rows that fail the base rules take no part in the estimates. Every group, language and the whole table get two starts: the mean and
    covariance of all rows, and medians with quartile ranges. Each concentration step takes, by a histogram of the
    distances that keeps sums of products, the nearest H of the rows (with ties) and computes their mean and
    covariance; the start that ends at the smaller determinant is used. Sums are of integers, so any order of rows
    gives the same result, and a group is never gathered: it is one row for each of at most 700 histogram bins.
    """
    # a group may hold most rows: they join its estimates by a salt too, so that none of its rows need be together
    k = "lvl, lang, source, start"
    xs = ", ".join(f"x{i}" for i in range(P))
    on = " AND ".join(f"e.{x} = p.{x}" for x in ("lvl", "lang", "source", "salt"))
    sums = ", ".join([f"sum(x{i}) AS s{i}" for i in range(P)] + [f"sum(x{i} * x{j}) AS s{i}{j}" for i, j in _PAIRS])
    again = ", ".join([f"sum(s{i}) AS s{i}" for i in range(P)] + [f"sum(s{i}{j}) AS s{i}{j}" for i, j in _PAIRS])
    chol = []
    for i, j in _PAIRS:
        less = "".join(f" - l{i}{m} * l{j}{m}" for m in range(j))
        chol.append(f"sqrt(c{i}{j}{less}) AS l{i}{j}" if i == j else f"(c{i}{j}{less}) / l{j}{j} AS l{i}{j}")
    chol.append(" * ".join(f"l{i}{i}" for i in range(P)) + " AS det")
    names = ", ".join([f"m{i}" for i in range(P)] + [f"l{i}{j}" for i, j in _PAIRS] + ["det"])
    means = ", ".join(f"cast(s{i} AS double) / cast(n AS double) / {UNIT}.0e0 AS m{i}" for i in range(P))
    # the diagonal start comes from quartiles, the others from sums
    covs = ", ".join(f"{CONSISTENT}e0 * (cast(s{i}{j} AS double) / cast(n AS double) / {UNIT * UNIT}.0e0 - m{i} * m{j})" + (f" + {FLOORS[i] ** 2:.6f}e0" if i == j else "") + f" AS c{i}{j}" for i, j in _PAIRS)
    z = []
    for i in range(P):
        less = "".join(f" - l{i}{m} * z{m}" for m in range(i))
        z.append(f"(x{i} / {UNIT}.0e0 - m{i}{less}) / l{i}{i} AS z{i}")
    z.append(" + ".join(f"z{i} * z{i}" for i in range(P)) + " AS d2")
    zs = ", ".join(z)
    half = ", ".join(f"{percentile}(x{i}, 0.5) / {UNIT}.0e0 AS m{i}, ({percentile}(x{i}, 0.75) - {percentile}(x{i}, 0.25)) / {UNIT}.0e0 / 1.349e0 AS q{i}" for i in range(P))
    diag = ", ".join(f"q{i} * q{i} + {FLOORS[i] ** 2:.6f}e0 AS c{i}{i}" if i == j else f"0.0e0 AS c{i}{j}" for i, j in _PAIRS)
    parts = [
        "@e AS (" + " UNION ALL ".join(f"SELECT {lvl} AS lvl, {la} AS lang, {so} AS source, (x0 + x1 + x2 + x3) % {SALTS} AS salt, {xs} FROM {stats} WHERE NOT {BASE_FAILED}" for lvl, la, so in ((0, "''", "''"), (1, "lang", "''"), (2, "lang", "source"))) + ")",
        f"@a0 AS (SELECT lvl, lang, source, 0 AS start, count(*) AS n, {sums} FROM @e GROUP BY lvl, lang, source)",
        f"@b0 AS (SELECT lvl, lang, source, 1 AS start, count(*) AS n, {half} FROM @e GROUP BY lvl, lang, source)",
        f"@a1 AS (SELECT *, {means} FROM @a0)",
        f"@a2 AS (SELECT *, {covs} FROM @a1)",
        f"@b1 AS (SELECT *, {diag} FROM @b0)",
        f"@a3 AS (SELECT *, {', '.join(chol)} FROM @a2)",
        f"@b2 AS (SELECT *, {', '.join(chol)} FROM @b1)",
        f"@p0 AS (SELECT {k}, n AS total, {names} FROM @a3 UNION ALL SELECT {k}, n AS total, {names} FROM @b2)",
    ]
    for s in range(1, STEPS + 1):
        parts += [
            f"@d{s} AS (SELECT e.*, p.start AS start, p.total AS total, {', '.join('p.' + x for x in names.split(', ') if x != 'det')} FROM @e e JOIN (SELECT *, {salts} AS salt FROM @p{s - 1}) p ON {on})",
            f"@z{s} AS (SELECT {k}, total, {', '.join(f'x{i}' for i in range(P))}, {zs} FROM @d{s})",
            f"@h{s} AS (SELECT {k}, total, cast(floor(16 * ln(1 + d2) / ln(2.0e0)) AS bigint) AS bin, count(*) AS n, {sums} FROM @z{s} GROUP BY {k}, total, cast(floor(16 * ln(1 + d2) / ln(2.0e0)) AS bigint))",
            f"@r{s} AS (SELECT *, sum(n) OVER (PARTITION BY {k} ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM @h{s})",
            f"@t{s} AS (SELECT {k}, total, sum(n) AS n, {again} FROM @r{s} WHERE upto - n < {H}e0 * total GROUP BY {k}, total)",
            f"@u{s} AS (SELECT *, {means} FROM @t{s})",
            f"@v{s} AS (SELECT *, {covs} FROM @u{s})",
            f"@p{s} AS (SELECT {k}, total, {names} FROM (SELECT *, {', '.join(chol)} FROM @v{s}) c)",
        ]
    cols = names.split(", ")
    parts += [
        f"@best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lvl, lang, source ORDER BY det, start) AS rn FROM @p{STEPS}) b WHERE rn = 1 AND total >= {LEAST_ROWS})",
        f"@g AS (SELECT lang, source, 0 AS top FROM {stats} GROUP BY lang, source)",
        "@est AS (SELECT g.lang AS lang, g.source AS source, "
        + ", ".join(f"coalesce(x.{c}, y.{c}, w.{c}) AS {c}" for c in cols)
        + " FROM @g g LEFT JOIN (SELECT * FROM @best WHERE lvl = 2) x ON g.lang = x.lang AND g.source = x.source LEFT JOIN (SELECT * FROM @best WHERE lvl = 1) y ON g.lang = y.lang LEFT JOIN (SELECT * FROM @best WHERE lvl = 0) w ON g.top = w.lvl)",
        f"@q AS (SELECT s.*, {', '.join('t.' + c for c in cols)} FROM {stats} s JOIN (SELECT *, {salts} AS salt FROM @est) t ON s.lang = t.lang AND s.source = t.source AND (s.x0 + s.x1 + s.x2 + s.x3) % {SALTS} = t.salt)",
    ]
    parts.append(f"@far AS (SELECT *, {zs} FROM @q)")
    return [(x.partition(" AS (")[0][1:], x.partition(" AS (")[2][:-1].replace("@", prefix)) for x in parts]


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", carry: list[str] | None = None) -> DataFrame:
    """The columns carry of docs (all if not given) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed, kept and d2.

    A row that fails the base rules isn't kept; of the others, those whose squared distance d2 from the robust centre
    of their language and source exceeds CUTOFF are rejected. A null text is empty and fails; a null language or source
    is a group of its own. Each of repeated or tied rows is judged by itself. In a table with fewer than LEAST_ROWS rows
    only the base rules reject, and d2 is null. Columns of docs with the names of the new ones are replaced.
    """
    spark = docs.sparkSession
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
    new = [*made, "base_failed", "kept", "d2"]
    held = [c for c in (docs.columns if carry is None else carry) if c not in new]
    key = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")).alias(k) for c, k in ((lang, "lang"), (source, "source"))]
    plain = docs.select(F.struct(*[F.col(f"`{c}`") for c in held]).alias("doc"), F.col(text).alias("text_"), *key)
    rows = table(statistics(plain, "text_").drop("text_").selectExpr("*", *VECTOR), "stats")
    rows.createOrReplaceTempView(view := f"stats_{uuid.uuid4().hex[:12]}")
    views = [view]
    for name, sql in mcd_sql(view, "percentile", f"explode(sequence(0, {SALTS - 1}))", f"{view}_"):
        far = spark.sql(sql)
        if re.fullmatch(r"p\d|est", name):  # a few numbers for each group: written, so that plans stay small
            far = table(far, "estimates")
        far.createOrReplaceTempView(f"{view}_{name}")
        views.append(f"{view}_{name}")
    for name in views:
        spark.catalog.dropTempView(name)
    far = far.withColumn("base_failed", F.expr(BASE_FAILED))
    return far.select("doc.*", *made, "base_failed", (~F.col("base_failed") & F.coalesce(F.col("d2") <= CUTOFF, F.lit(True))).alias("kept"), "d2")


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    out = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"), carry=["doc_id"]).select(out)


def _sql() -> str:
    """The same for DuckDB over documents; the statistics are computed from unnested words, the estimates by the same SQL."""
    stats = rf"""
    WITH w AS (SELECT doc_id, lang, source, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l, coalesce(text, '') AS t FROM documents),
    g AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
    d AS (SELECT DISTINCT doc_id, i + k AS i FROM (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1), range(5) r(k)),
    r AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
    s AS (SELECT w.doc_id AS doc_id, coalesce('=' || lang, '-') AS lang, coalesce('=' || source, '-') AS source, cast(len(w) AS bigint) AS n_words,
        cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS bigint) AS word_chars, cast(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS bigint) AS n_symbols,
        cast(len(l) AS bigint) AS n_lines, cast(len(l) - len(list_distinct(l)) AS bigint) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
        FROM w LEFT JOIN r ON w.doc_id = r.doc_id)
    SELECT *, {", ".join(VECTOR)} FROM s"""
    inner = ", ".join(f"{name} AS ({sql})" for name, sql in mcd_sql("stats", "quantile_cont", f"unnest(range({SALTS}))"))
    return f"""WITH stats AS MATERIALIZED ({stats}), {inner}
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {BASE_FAILED} AS base_failed, NOT {BASE_FAILED} AND coalesce(d2 <= {CUTOFF}, true) AS kept FROM far"""


SQL = _sql()
