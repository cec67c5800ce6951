"""Queries over metric series, rasters and streams."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import raster as R
from ..sources.tables import STAGES, corpus, read, samples, shared_folder
from ..streaming import tail

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES["q_" + f.__name__] = f
        if oracle is not None:
            ORACLES["q_" + f.__name__] = oracle
        return f

    return add


D_STAGES = ", ".join(f"({o}, '{s}', {a}, {b})" for o, s, a, b in STAGES)
TAGGED = f"""WITH st(ord, stage, h0, h1) AS (VALUES {D_STAGES}), sm AS (SELECT user_id AS series, ts, event_id, value AS util, event_type FROM events),
tg AS (SELECT sm.*, coalesce((SELECT arg_min(stage, ord) FROM st WHERE sm.ts >= date_trunc('day', sm.ts) + to_hours(h0) AND sm.ts <= date_trunc('day', sm.ts) + to_hours(h1)), '(idle)') AS stage FROM sm)"""


def _tagged(spark, sf_dir):
    s = samples(spark, sf_dir)
    days = s.select(F.date_trunc("DAY", "ts").alias("day")).distinct()
    return M.tag(s, M.stage_windows(spark, days))


@query(f"{TAGGED} SELECT event_id, stage FROM tg")
def stage_tag(spark, sf_dir):
    return _tagged(spark, sf_dir).select("event_id", "stage")


@query(f"{TAGGED} SELECT event_id, stage FROM tg")
def stage_tag_stream(spark, sf_dir):
    s = samples(spark, sf_dir)
    days = s.select(F.date_trunc("DAY", "ts").alias("day")).distinct()
    return M.tag_stream(s, M.day_windows(M.stage_windows(spark, days))).select("event_id", "stage")


@query(f"{TAGGED} SELECT CASE stage WHEN '(idle)' THEN '(unstaged)' ELSE stage END AS stage, count(*) AS n, round(avg(util), 3) AS mean, min(ts) AS t0, max(ts) AS t1 FROM tg GROUP BY 1")
def stage_windows(spark, sf_dir):
    return M.stage_seconds(_tagged(spark, sf_dir))


STATS = "count(util) AS n, round(min(util), 3) AS min, round(avg(util), 3) AS mean, round(max(util), 3) AS max, round(quantile_disc(util, 0.95), 3) AS p95, round(arg_max(util, (ts, event_id)), 3) AS last"


@query(f"{TAGGED} SELECT stage, {STATS} FROM tg GROUP BY stage")
def stats(spark, sf_dir):
    return M.stats(_tagged(spark, sf_dir), ["stage"])


@query("""WITH s AS (SELECT user_id AS series, ts, event_id, value AS util, coalesce(value < 20, false) AS low FROM events),
r AS (SELECT *, sum(CASE WHEN low THEN 0 ELSE 1 END) OVER (PARTITION BY series ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM s),
e AS (SELECT series, run, count(*) AS length FROM r WHERE low GROUP BY series, run),
g AS (SELECT series, count(*) AS episodes, avg(length) AS mean_len, max(length) AS max_len FROM e GROUP BY series),
p AS (SELECT series, avg(CASE WHEN low THEN 1.0 ELSE 0 END) AS idle_frac, avg(CASE WHEN NOT low THEN util END) AS busy_mean FROM s GROUP BY series)
SELECT p.series AS series, round(idle_frac, 3) AS idle_frac, coalesce(episodes, 0) AS episodes, round(mean_len, 3) AS mean_len, coalesce(max_len, 0) AS max_len, round(busy_mean, 3) AS busy_mean FROM p LEFT JOIN g ON p.series = g.series""")
def duty_cycle(spark, sf_dir):
    return M.duty_cycle(samples(spark, sf_dir), 20)


DIPS = f"""{TAGGED}, b AS (SELECT *, CASE WHEN coalesce(lag(stage) OVER w <> stage, true) THEN ts END AS start FROM tg WINDOW w AS (PARTITION BY series ORDER BY ts, event_id)),
c AS (SELECT *, max(start) OVER (PARTITION BY series ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS block_start, sum(CASE WHEN coalesce(util < 20, false) THEN 0 ELSE 1 END) OVER (PARTITION BY series ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM b),
d AS (SELECT series, run, min(ts) AS t0, max(ts) AS t1, count(*) AS n, arg_min(stage, (ts, event_id)) AS stage, arg_min(block_start, (ts, event_id)) AS bs, round(avg(util), 1) AS mean FROM c WHERE util < 20 GROUP BY series, run)
SELECT series, t0, t1, n, cast(floor((epoch_us(t1) - epoch_us(t0)) / 1000000) AS bigint) AS seconds, stage,
    CASE WHEN stage IN ('assembly', 'rasterize') THEN 'expected_cpu_stage' WHEN stage = 'ocr' AND (epoch_us(t0) - epoch_us(bs)) / 1000000 <= 7200 THEN 'cold_start' ELSE 'stall' END AS kind, mean,
    CASE WHEN stage IN ('assembly', 'rasterize') OR stage = 'ocr' AND (epoch_us(t0) - epoch_us(bs)) / 1000000 <= 7200 THEN 'info' ELSE 'warn' END AS severity FROM d WHERE floor((epoch_us(t1) - epoch_us(t0)) / 1000000) >= 3600"""


@query(DIPS)
def dips(spark, sf_dir):
    return M.dips(_tagged(spark, sf_dir), 20, 3600, 7200)


VERDICT = "event_id, value % 7 / 70 AS swap_delta, value % 11 AS avail, value AS gpu, value * 3 AS cpu, 4 AS cores, value / 2 AS sys, event_id % 10 / cast(10 AS double) AS idle, CASE event_id % 4 WHEN 0 THEN 'nvml' WHEN 1 THEN 'powermetrics' WHEN 2 THEN 'ioreg' ELSE 'off' END AS provider"


@query(f"""WITH m AS (SELECT {VERDICT} FROM events), b AS (SELECT *, coalesce(CASE provider WHEN 'ioreg' THEN gpu >= 50 WHEN 'off' THEN false ELSE gpu >= 70 END, false) AS g, coalesce(cpu >= 85 * cores, false) OR coalesce(sys >= 85, false) AS c FROM m)
SELECT event_id, CASE WHEN swap_delta > 0.05 OR avail < 2 THEN 'memory' WHEN g AND c THEN 'mixed' WHEN g THEN 'gpu' WHEN c THEN 'cpu' WHEN gpu IS NOT NULL OR cpu IS NOT NULL THEN 'underutilised' ELSE 'unknown' END AS verdict,
    concat_ws(',', CASE WHEN idle >= 0.2 THEN 'stalls again and again' END, CASE WHEN swap_delta > 0.05 THEN 'swaps' END, CASE WHEN avail < 2 THEN 'little memory left' END, CASE WHEN gpu IS NOT NULL THEN 'GPU of the whole machine' END, CASE WHEN g AND provider = 'ioreg' THEN 'GPU use is understated' END) AS notes FROM b""")
def interpret(spark, sf_dir):
    return M.verdict(read(spark, sf_dir, "events").selectExpr(*VERDICT.split(", "))).select("event_id", "verdict", "notes")


@query("SELECT user_id AS series, event_type, round(arg_max(value, (ts, event_id)) - arg_min(value, (ts, event_id)), 3) AS delta FROM events GROUP BY 1, 2")
def deltas(spark, sf_dir):
    return M.deltas(samples(spark, sf_dir), ["series", "event_type"])


RUNS = "user_id AS run, event_id % 40 + 1 AS pages, event_id % 97 AS seconds, cast(event_id % 101 AS double) AS busy, event_id % 10 / 10 AS idle, event_id % 13 AS avail, event_id % 50 = 0 AS swap"
D_RUNS = RUNS.replace("event_id % 10 / 10", "event_id % 10 / 10.0e0")
D_AGG = f"WITH r AS (SELECT {D_RUNS} FROM events), g AS (SELECT run, sum(seconds) / sum(pages) AS s_page, avg(busy) AS busy, avg(idle) AS idle, min(avail) AS avail, bool_or(swap) AS swapped FROM r GROUP BY run)"


def _runs(spark, sf_dir):
    return M.aggregate_runs(read(spark, sf_dir, "events").selectExpr(*RUNS.split(", ")))


@query(f"{D_AGG} SELECT run, round(s_page, 6) AS s_page, round(busy, 6) AS busy, round(idle, 6) AS idle, avail, swapped FROM g")
def agg_runs(spark, sf_dir):
    return _runs(spark, sf_dir).select("run", F.round("s_page", 6).alias("s_page"), F.round("busy", 6).alias("busy"), F.round("idle", 6).alias("idle"), "avail", "swapped")


@query(f"{D_AGG} SELECT run, CASE WHEN swapped OR avail < 2 THEN 'reduce instances' WHEN round(idle, 3) >= 0.2 THEN 'fix stalls first' WHEN round(busy, 1) >= 88 THEN 'saturated' WHEN round(busy, 1) <= 70 THEN 'headroom: add an instance' ELSE 'balanced' END AS action FROM g")
def recommend(spark, sf_dir):
    return M.recommend(_runs(spark, sf_dir)).select("run", "action")


PROCS = "user_id AS series, CASE event_type WHEN 'click' THEN 'llama-server' WHEN 'view' THEN 'surya' ELSE 'helper' END AS name, event_type AS cmd, value AS cpu"


@query(f"""WITH p AS (SELECT {PROCS} FROM events)
SELECT series, round(sum(cpu), 3) AS tree_cpu, count(*) AS n_procs, round(sum(cpu) FILTER (name = 'llama-server' OR name = 'surya'), 3) AS own_cpu, string_agg(DISTINCT name, ',' ORDER BY name) FILTER (name = 'llama-server' OR name = 'surya') AS names FROM p GROUP BY series""")
def proc_profile(spark, sf_dir):
    p = read(spark, sf_dir, "events").selectExpr("user_id AS series", "CASE event_type WHEN 'click' THEN 'llama-server' WHEN 'view' THEN 'surya' ELSE 'helper' END AS name", "event_type AS cmd", "value AS cpu")
    return M.process_profile(p, ["LLAMA", "surya"], ["series"])


@query("SELECT user_id AS series, round(coalesce(sum(value) FILTER (event_type IN ('click', 'view')), 0), 3) AS model, round(coalesce(sum(value) FILTER (event_type = 'view'), 0), 3) AS surya FROM events GROUP BY user_id")
def named_sums(spark, sf_dir):
    p = read(spark, sf_dir, "events").selectExpr("user_id AS series", "event_type AS name", "'' AS cmd", "value AS cpu")
    return M.named_sums(p, {"model": ["CLICK", "view"], "surya": ["view"]}, ["series"])


@query("""WITH RECURSIVE p AS (SELECT event_id AS pid, event_id // 3 AS ppid FROM events WHERE event_id > 0), t(pid, root, depth) AS (SELECT pid, pid, 0 FROM p WHERE ppid = 0 UNION ALL SELECT p.pid, t.root, t.depth + 1 FROM t JOIN p ON p.ppid = t.pid AND p.pid <> t.pid)
SELECT pid, root, depth FROM t""")
def proc_tree(spark, sf_dir):
    p = read(spark, sf_dir, "events").filter("event_id > 0").selectExpr("event_id AS pid", "event_id div 3 AS ppid")
    return M.process_tree(p, spark)


@query("""WITH h AS (SELECT l_suppkey % 8 AS img, cast(l_quantity * 5 AS bigint) % 256 AS bin, count(*) AS n FROM lineitem GROUP BY 1, 2),
c AS (SELECT *, sum(n) OVER w AS wb, sum(bin * n) OVER w AS sb, sum(n) OVER g AS tn, sum(bin * n) OVER g AS ts FROM h WINDOW w AS (PARTITION BY img ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), g AS (PARTITION BY img)),
v AS (SELECT *, CASE WHEN tn > wb THEN cast(wb AS double) * (tn - wb) * (cast(sb AS double) / wb - cast(ts - sb AS double) / (tn - wb)) ** 2 END AS v FROM c)
SELECT img, bin AS threshold FROM v QUALIFY row_number() OVER (PARTITION BY img ORDER BY coalesce(v, -1) DESC, bin) = 1""")
def otsu(spark, sf_dir):
    h = read(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 8).alias("img"), ((F.col("l_quantity") * 5).cast("long") % 256).alias("bin")).groupBy("img", "bin").agg(F.count(F.lit(1)).alias("n"))
    return R.otsu(h, ["img"])


def rasters() -> list[tuple[int, int, int, bytearray]]:
    """two columns; one column; a thin line at row 30; a waved line; blank; a wide page of two."""
    out = []
    for kind in range(6):
        h, w = (40, 60) if kind != 5 else (40, 100)
        a = np.full((h, w), 255, np.uint8)
        if kind in (0, 5):
            a[2:38, 4 : w // 2 - 3] = a[2:38, w // 2 + 3 : w - 4] = 0
        if kind == 1:
            a[2:38:2, 4:56] = 0
        if kind == 2:
            a[30, 5:30] = 0
        if kind == 3:
            for x in range(5, 50):
                a[30 + x % 3, x] = 0
        out.append((kind, h, w, bytearray(a.tobytes())))
    return out


@query()
def gutter(spark, sf_dir):
    return R.profiles(spark.createDataFrame(rasters(), "id long, h int, w int, data binary"))


@query("SELECT 0::bigint AS id, 23::bigint AS longest UNION ALL SELECT 1, 52 UNION ALL SELECT 2, 25 UNION ALL SELECT 3, 1 UNION ALL SELECT 4, 0 UNION ALL SELECT 5, 43")
def row_runs(spark, sf_dir):
    return R.profiles(spark.createDataFrame(rasters(), "id long, h int, w int, data binary")).select("id", "longest")


def _files(df, parts: int) -> str:
    folder = shared_folder(df.sparkSession, "stream")
    df.repartition(parts).write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(folder)
    return folder


@query("SELECT edition, title FROM (SELECT p_partkey AS edition, p_name || '-v2' AS title, p_partkey AS k FROM part)")
def stream_manifest(spark, sf_dir):
    c = corpus(spark, sf_dir).select("edition", "title")
    old, new = c.withColumn("version", F.lit(1)), c.withColumns({"title": F.concat("title", F.lit("-v2")), "version": F.lit(2)})
    folder = _files(old.unionByName(new), 3)
    rows = tail.manifest(spark, folder, "edition long, title string, version int")
    return tail.latest(rows, "edition", "version", shared_folder(spark, "manifest")).select("edition", "title")


@query(f"SELECT series, t0, t1, n FROM ({DIPS}) x")
def stream_dips(spark, sf_dir):
    schema = "series long, ts timestamp, event_id long, util double"
    folder = _files(tail.closed(samples(spark, sf_dir).select("series", "ts", "event_id", "util")), 1)
    stream = spark.readStream.schema(schema).json(folder)
    return tail.run_to_files(tail.dip_stream(stream, 20, 3600), shared_folder(spark, "dips"))


@query(f"{D_AGG} SELECT run, row_number() OVER (ORDER BY nullif(s_page, 0) ASC NULLS LAST, run) AS place FROM g")
def run_order(spark, sf_dir):
    # a row per run: so few that one window holds them
    runs = M.fastest_first(_runs(spark, sf_dir)).select("run", "s_page")
    return runs.withColumn("place", F.row_number().over(Window.orderBy(F.nullif(F.col("s_page"), F.lit(0)).asc_nulls_last(), "run")).cast("long")).drop("s_page")


SPAN = ("2024-01-05 00:00:00", "2024-01-20 12:00:00")


@query(f"SELECT user_id AS series, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS util FROM events WHERE ts BETWEEN '{SPAN[0]}' AND '{SPAN[1]}' GROUP BY user_id")
def sample_window(spark, sf_dir):
    return M.latest(M.in_window(samples(spark, sf_dir), *SPAN)).select("series", "ts", "event_id", "util")


def _peaks(tagged):
    """A detector beside the built-in one: samples far above the scale."""
    high = tagged.filter("util >= 300")
    return high.select("series", F.col("ts").alias("t0"), F.col("ts").alias("t1"), F.lit("peak").alias("kind"), F.lit("info").alias("severity"), M.rounded(F.col("util"), 1).alias("mean"))


@query(f"SELECT series, t0, t1, kind, severity, mean, 'dip' AS detector FROM ({DIPS}) x UNION ALL SELECT user_id, ts, ts, 'peak', 'info', round(value, 1), 'peak' FROM events WHERE value >= 300")
def detect(spark, sf_dir):
    return M.detect(_tagged(spark, sf_dir), {"dip": lambda t: M.dips(t, 20, 3600, 7200), "peak": _peaks})


CLOCKS = "CASE event_id % 5 WHEN 0 THEN '1:02.50' WHEN 1 THEN '01:02:03' WHEN 2 THEN '2-03:04:05' WHEN 3 THEN 'x:1' ELSE '59' END"


@query(f"SELECT event_id, cast(CASE event_id % 5 WHEN 0 THEN 62.5 WHEN 1 THEN 3723 WHEN 2 THEN 183845 WHEN 3 THEN 0 ELSE 59 END AS double) AS seconds FROM events")
def cpu_time(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", M.cpu_seconds(F.expr(CLOCKS)).alias("seconds"))
