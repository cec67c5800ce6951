"""Metric series: stages, statistics, duty cycles, dips, verdicts."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from ..sources.tables import STAGES, shared_folder


def stage_windows(spark: SparkSession, days: DataFrame) -> DataFrame:
    """The stages of each day in days(day): ord, stage, a, b."""
    s = spark.createDataFrame(STAGES, "ord int, stage string, h0 int, h1 int")
    at = lambda h: F.timestamp_add("HOUR", F.col(h), F.col("day"))
    return days.join(F.broadcast(s)).select("day", "ord", "stage", at("h0").alias("a"), at("h1").alias("b"))


def tag(samples: DataFrame, stages: DataFrame) -> DataFrame:
    """samples with the first stage whose window holds their time, else (idle); windows are joined by their day. Repeated rows stay."""
    return tag_stream(samples, day_windows(stages))


def day_windows(stages: DataFrame) -> DataFrame:
    """The stage windows of each day as one row, in order."""
    return stages.groupBy("day").agg(F.sort_array(F.collect_list(F.struct("ord", "stage", "a", "b"))).alias("windows"))


def tag_stream(stream: DataFrame, windows: DataFrame, none: str = "(idle)") -> DataFrame:
    """tag() without a state, for streams: joined with day_windows(), a static table."""
    s = stream.withColumn("day", F.date_trunc("DAY", "ts")).join(windows, "day", "left")
    hit = F.get(F.filter("windows", lambda w: (F.col("ts") >= w["a"]) & (F.col("ts") <= w["b"])), F.lit(0))["stage"]
    return s.withColumn("stage", F.coalesce(hit, F.lit(none))).drop("day", "windows")


def stage_seconds(samples: DataFrame, by: str = "stage") -> DataFrame:
    """Samples, mean, and least and largest time per stage; what lies in none is (unstaged)."""
    s = samples.withColumn(by, F.when(F.col(by) == "(idle)", "(unstaged)").otherwise(F.col(by)))
    return s.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("util"), 3).alias("mean"), F.min("ts").alias("t0"), F.max("ts").alias("t1"))


def named_sums(procs: DataFrame, names: dict[str, list[str]], by: list[str]) -> DataFrame:
    """Sums of cpu per sample over the processes whose name or command holds one of each entry's needles."""
    hay = F.lower(F.concat_ws(" ", "name", "cmd"))
    holds = lambda needles: F.exists(F.array(*[F.lit(n.lower()) for n in needles]), lambda n: F.instr(hay, n) > 0)
    return procs.groupBy(*by).agg(*[F.round(F.coalesce(F.sum(F.when(holds(v), F.col("cpu"))), F.lit(0.0)), 3).alias(k) for k, v in names.items()])


def stats(samples: DataFrame, by: list[str], value: str = "util") -> DataFrame:
    """n, least, mean, largest, nearest-rank 95th percentile, last; rounded to 3 places."""
    r = lambda c: F.round(c, 3)
    p95 = F.expr(f"percentile_disc(0.95) WITHIN GROUP (ORDER BY {value})")
    return samples.groupBy(*by).agg(F.count(value).alias("n"), r(F.min(value)).alias("min"), r(F.avg(value)).alias("mean"), r(F.max(value)).alias("max"), r(p95).alias("p95"), r(F.max_by(value, F.struct("ts", "event_id"))).alias("last"))


def in_order(*by: str) -> WindowSpec:
    """Per group the samples by time and number; those without come last."""
    return Window.partitionBy(*by).orderBy(F.asc_nulls_last("ts"), F.asc_nulls_last("event_id"))


def islands(samples: DataFrame, below: float, value: str = "util") -> DataFrame:
    """Rows below a bound with the number of their run: rows not below it, or without a value, end a run."""
    w = in_order("series")
    low = F.coalesce(F.col(value) < below, F.lit(False))
    out = samples.withColumn("low", low).withColumn("run", F.sum((~F.col("low")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return out


def duty_cycle(samples: DataFrame, below: float) -> DataFrame:
    """Per series the idle share, idle runs, their mean and largest length, and the mean of the busy samples."""
    s = islands(samples, below)
    per = s.groupBy("series").agg(F.avg(F.col("low").cast("int")).alias("idle_frac"), F.avg(F.when(~F.col("low"), F.col("util"))).alias("busy_mean"))
    runs = s.filter("low").groupBy("series", "run").agg(F.count(F.lit(1)).alias("length")).groupBy("series").agg(F.count(F.lit(1)).alias("episodes"), F.avg("length").alias("mean_len"), F.max("length").alias("max_len"))
    r = lambda c: F.round(c, 3)
    return per.join(runs, "series", "left").select("series", r("idle_frac").alias("idle_frac"), F.coalesce("episodes", F.lit(0)).alias("episodes"), r("mean_len").alias("mean_len"), F.coalesce("max_len", F.lit(0)).alias("max_len"), r("busy_mean").alias("busy_mean"))


def rounded(c: Column, places: int) -> Column:
    """A double to so many places as SQL's round(): the scaled double to the nearest whole one, halves away from zero. F.round() goes by the decimal digits instead, which for 13.049999999999999 are below 13.05; ten times it is 130.5."""
    scaled = c * 10.0**places
    return F.when(F.abs(scaled) < float("inf"), F.signum(c) * F.round(F.abs(scaled)) / 10.0**places).otherwise(c)


def dips(tagged: DataFrame, below: float, least_s: int, cold_s: int, cpu_stages: tuple[str, ...] = ("assembly", "rasterize")) -> DataFrame:
    """Runs below the bound of at least least_s seconds with their mean, by kind: expected in stages that use no GPU; a cold start soon after a stage of recognition began; else a stall, which alone is a warning."""
    w = in_order("series")
    t = tagged.withColumn("new", F.coalesce((F.lag("stage").over(w) != F.col("stage")), F.lit(True)))
    t = t.withColumn("block_start", F.max(F.when(F.col("new"), F.col("ts"))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # the mean so far, in order: a sum of doubles depends on it, and an aggregate may merge parts of a run
    r = in_order("series", "run")
    low = islands(t, below).filter("low").withColumns({"place": F.row_number().over(r), "so_far": F.avg("util").over(r.rowsBetween(Window.unboundedPreceding, 0))})
    d = low.groupBy("series", "run").agg(F.min("ts").alias("t0"), F.max("ts").alias("t1"), F.count(F.lit(1)).alias("n"), F.min_by(F.struct("stage", "block_start"), "place").alias("first"), rounded(F.max_by("so_far", "place"), 1).alias("mean"))
    us = lambda c: F.unix_micros(c.cast("timestamp"))
    d = d.withColumn("seconds", F.floor((us(F.col("t1")) - us(F.col("t0"))) / 1000000)).filter(F.col("seconds") >= least_s)
    since = (us(F.col("t0")) - us(F.col("first.block_start"))) / 1000000
    kind = F.when(F.col("first.stage").isin(*cpu_stages), "expected_cpu_stage").when((F.col("first.stage") == "ocr") & (since <= cold_s), "cold_start").otherwise("stall")
    return d.select("series", "t0", "t1", "n", "seconds", F.col("first.stage").alias("stage"), kind.alias("kind"), F.when(kind == "stall", "warn").otherwise("info").alias("severity"), "mean")


def verdict(m: DataFrame) -> DataFrame:
    """m(swap_delta, avail, gpu, cpu, cores, sys) with verdict, in order: memory, mixed, gpu, cpu, underutilised, unknown; and notes.

    With a column provider the bound of the GPU is the provider's; one that isn't known measures nothing to go by. A column
    idle, the idle share of the stage, is noted from a fifth on.
    """
    busy = F.lit(70.0)
    if "provider" in m.columns:
        busy = F.create_map(*[F.lit(x) for kv in GPU_BOUND.items() for x in kv])[F.col("provider")]
    gpu, cpu = F.coalesce(F.col("gpu") >= busy, F.lit(False)), (F.col("cpu") >= 85 * F.col("cores")) | (F.col("sys") >= 85)
    v = F.when((F.col("swap_delta") > 0.05) | (F.col("avail") < 2), "memory").when(gpu & cpu, "mixed").when(gpu, "gpu").when(cpu, "cpu").when(F.col("gpu").isNotNull() | F.col("cpu").isNotNull(), "underutilised").otherwise("unknown")
    idle = F.col("idle") if "idle" in m.columns else F.lit(None).cast("double")
    low = F.coalesce(busy == GPU_BOUND["ioreg"], F.lit(False)) & gpu
    notes = F.array(
        F.when(idle >= 0.2, "stalls again and again"),
        F.when(F.col("swap_delta") > 0.05, "swaps"),
        F.when(F.col("avail") < 2, "little memory left"),
        F.when(F.col("gpu").isNotNull(), "GPU of the whole machine"),
        F.when(low, "GPU use is understated"),
    )
    return m.withColumns({"verdict": v, "notes": F.array_join(F.filter(notes, lambda x: x.isNotNull()), ",")})


#: From which use on the GPU is the bound, by who measures it.
GPU_BOUND = {"nvml": 70.0, "powermetrics": 70.0, "ioreg": 50.0}


def deltas(samples: DataFrame, by: list[str]) -> DataFrame:
    """Last value less the first."""
    k = F.struct("ts", "event_id")
    return samples.groupBy(*by).agg(F.round(F.max_by("util", k) - F.min_by("util", k), 3).alias("delta"))


def aggregate_runs(runs: DataFrame) -> DataFrame:
    """runs(run, pages, seconds, busy, idle, avail, swap): seconds a page weighted by pages, means, least memory, any swap; the fastest first."""
    g = runs.groupBy("run").agg((F.sum("seconds") / F.sum("pages")).alias("s_page"), F.avg("busy").alias("busy"), F.avg("idle").alias("idle"), F.min("avail").alias("avail"), F.bool_or("swap").alias("swapped"))
    return g


def recommend(runs: DataFrame) -> DataFrame:
    """What to change, by ordered rules: memory first, then stalls, then how busy the GPU is at work; no measurement is balance."""
    a = F.when(F.col("swapped") | (F.col("avail") < 2), "reduce instances").when(F.round("idle", 3) >= 0.2, "fix stalls first")
    a = a.when(F.round("busy", 1) >= 88, "saturated").when(F.round("busy", 1) <= 70, "headroom: add an instance").otherwise("balanced")
    return runs.withColumn("action", a)


def fastest_first(runs: DataFrame) -> DataFrame:
    """aggregate_runs() in order of their seconds a page; runs without any, or with none measured, stand last."""
    return runs.orderBy(F.nullif(F.col("s_page"), F.lit(0)).asc_nulls_last(), "run")


def in_window(samples: DataFrame, t0: str, t1: str) -> DataFrame:
    """The samples from t0 to t1, both included."""
    return samples.filter((F.col("ts") >= F.lit(t0).cast("timestamp")) & (F.col("ts") <= F.lit(t1).cast("timestamp")))


def latest(samples: DataFrame) -> DataFrame:
    """Of each series the last sample; none where there is none."""
    others = [c for c in samples.columns if c != "series"]
    return samples.groupBy("series").agg(F.max_by(F.struct(*others), F.struct("ts", "event_id")).alias("s")).select("series", "s.*")


#: Detectors by name: functions of tagged samples that return findings(series, t0, t1, kind, severity, mean). More may be registered.
DETECTORS: dict[str, Callable[[DataFrame], DataFrame]] = {"dip": lambda tagged: dips(tagged, 10, 10, 120)}


def detect(tagged: DataFrame, detectors: dict[str, Callable[[DataFrame], DataFrame]] | None = None) -> DataFrame:
    """The findings of all detectors, each with its detector's name."""
    found = [f(tagged).select("series", "t0", "t1", "kind", "severity", "mean", F.lit(name).alias("detector")) for name, f in (DETECTORS if detectors is None else detectors).items()]
    return functools.reduce(DataFrame.unionByName, found)


def cpu_seconds(text: Column) -> Column:
    """Seconds of [[dd-]hh:]mm:ss[.cc]; 0 for what isn't a time."""
    days = F.when(text.contains("-"), F.split_part(text, F.lit("-"), F.lit(1)).try_cast("double")).otherwise(0.0)
    clock = F.transform(F.split(F.when(text.contains("-"), F.regexp_replace(text, "^[^-]*-", "")).otherwise(text), ":"), lambda x: x.try_cast("double"))
    return F.when(F.exists(clock, lambda x: x.isNull()), 0.0).otherwise(F.aggregate(clock, F.lit(0.0), lambda a, x: a * 60 + x) + F.coalesce(days, F.lit(0.0)) * 86400)


def process_tree(procs: DataFrame, spark: SparkSession) -> DataFrame:
    """procs(pid, ppid) with the topmost ancestor and depth of each.

    A process whose parent is 0, null, itself or not among them is a root. Each round doubles how far everyone looks up, so
    a tree of depth n takes log2(n) of them; each is written, so that no lineage builds up. A circle stops the job.
    """
    own = procs.select("pid", "ppid")
    known = own.select(F.col("pid").alias("ppid"), F.lit(True).alias("known")).distinct()
    t = own.join(known, "ppid", "left").withColumn("up", F.when(F.col("known") & (F.col("ppid") != F.col("pid")) & (F.col("ppid") != 0), F.col("ppid")))
    t = t.select("pid", F.coalesce("up", "pid").alias("root"), F.col("up").isNotNull().cast("int").alias("depth"))
    deepest = -1
    for _ in range(40):
        path = shared_folder(spark, "procs")
        t.write.parquet(path)
        t = spark.read.schema(t.schema).parquet(path)
        now = t.agg(F.max("depth")).first()[0] or 0
        if now == deepest:
            return t
        deepest = now
        above = t.select(F.col("pid").alias("at"), F.col("root").alias("higher"), F.col("depth").alias("more"))
        t = t.join(above, F.col("root") == F.col("at")).select("pid", F.col("higher").alias("root"), (F.col("depth") + F.col("more")).alias("depth"))
    raise ValueError("processes that are their own ancestors")


def matches(procs: DataFrame, needles: list[str]) -> DataFrame:
    """procs(name, cmd) whose name or command holds one of the needles, whatever the case."""
    hay = F.lower(F.concat_ws(" ", "name", "cmd"))
    return procs.filter(F.exists(F.array(*[F.lit(n.lower()) for n in needles]), lambda n: F.instr(hay, n) > 0)) if needles else procs


def process_profile(procs: DataFrame, needles: list[str], by: list[str]) -> DataFrame:
    """Sums over all processes of a sample, and over the matched ones with their names."""
    own = matches(procs, needles).groupBy(*by).agg(F.sum("cpu").alias("own_cpu"), F.array_join(F.sort_array(F.collect_set("name")), ",").alias("names"))
    return procs.groupBy(*by).agg(F.round(F.sum("cpu"), 3).alias("tree_cpu"), F.count(F.lit(1)).alias("n_procs")).join(own, by, "left").withColumn("own_cpu", F.round("own_cpu", 3))
