"""Streams: a growing manifest, tagged samples with dips as state, and leases that run out."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def manifest(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Rows of the JSON lines files that appear in folder; blank and half-written lines are left out."""
    rows = spark.readStream.text(folder)
    parsed = rows.select(F.from_json("value", schema).alias("r")).select("r.*")
    return parsed.filter(F.col(parsed.columns[0]).isNotNull())


def latest(stream: DataFrame, key: str, order: str, folder: str) -> DataFrame:
    """Runs what has arrived; per key the row of the largest order. Each batch writes a new version of the table below folder from the last one."""
    others = [c for c in stream.columns if c != key]

    def merge(batch: DataFrame, number: int) -> None:
        if number:
            batch = batch.unionByName(batch.sparkSession.read.schema(batch.schema).parquet(f"{folder}/v{number - 1}"))
        new = batch.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("r")).select(key, "r.*")
        new.write.mode("overwrite").parquet(f"{folder}/v{number}")
        done.append(number)

    done: list[int] = []
    q = stream.writeStream.foreachBatch(merge).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.parquet(f"{folder}/v{done[-1]}") if done else stream.sparkSession.createDataFrame([], stream.schema)


def run_to_files(stream: DataFrame, folder: str) -> DataFrame:
    """Runs what has arrived into files below folder, and reads them."""
    q = stream.writeStream.outputMode("append").format("parquet").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")


def windowed(stream: DataFrame, late: str = "1 day", width: str = "1 day") -> DataFrame:
    """Counts and means of samples by series and window, with a watermark (an extension: the model has no event time)."""
    return stream.withWatermark("ts", late).groupBy("series", F.window("ts", width)).agg(F.count(F.lit(1)).alias("n"), F.avg("util").alias("mean"))


def dip_stream(stream: DataFrame, below: float, least_s: int) -> DataFrame:
    """Runs below the bound, as they end; closed() ends those of a recording that is over. stream(series, ts, event_id, util) must bring a series' rows in time order; the state is one open run a series."""

    def step(key: tuple, frames, state: GroupState):
        t0, t1, n = state.get if state.exists else (None, None, 0)
        out = []
        rows = pd.concat(list(frames)).sort_values(["ts", "event_id"])
        for ts, util in zip(rows["ts"], rows["util"], strict=True):
            us = ts.value // 1000
            if util == util and util < below:
                t0, t1, n = (us if t0 is None else t0), us, n + 1
            else:
                if t0 is not None and t1 - t0 >= least_s * 1_000_000:
                    out.append((key[0], pd.Timestamp(t0, unit="us"), pd.Timestamp(t1, unit="us"), n))
                t0, t1, n = None, None, 0
        state.update((t0, t1, n))
        if out:
            yield pd.DataFrame(out, columns=["series", "t0", "t1", "n"])

    return stream.groupBy("series").applyInPandasWithState(step, "series long, t0 timestamp, t1 timestamp, n long", "t0 long, t1 long, n long", "append", GroupStateTimeout.NoTimeout)


def closed(samples: DataFrame) -> DataFrame:
    """samples(series, ts, event_id, util) with a last row without a value for each series, a second behind its end: it ends the run that is open there."""
    end = samples.groupBy("series").agg(F.timestamp_add("SECOND", F.lit(1), F.max("ts")).alias("ts"), (F.max("event_id") + 1).alias("event_id"))
    return samples.unionByName(end.withColumn("util", F.lit(None).cast("double")).select(*samples.columns))


def expired(heartbeats: DataFrame, ttl: str) -> DataFrame:
    """heartbeats(name, ts): leases whose last sign of life is older than ttl before the latest of all."""
    last = heartbeats.groupBy("name").agg(F.max("ts").alias("ts"))
    now = heartbeats.agg(F.max("ts").alias("now"))
    return last.join(F.broadcast(now)).filter(F.col("ts") < F.col("now") - F.expr(f"INTERVAL {ttl}"))
