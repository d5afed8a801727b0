"""Incremental forms: a monthly composite that late scenes may still change, and alerts as keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..functions.months import ym_of
from ..params import PARAMS
from ..session import shared_folder

STATE = StructType([StructField("state", StringType()), *[StructField(n, IntegerType()) for n in ("first", "last", "n_seen", "t")]])
OUTPUT = "alert long, state string, first int, last int, n_seen int, t int"


def monthly(stream: DataFrame, time: str, cell: str, value: str, late: str = "6 days") -> DataFrame:
    """The greatest value and the count of each cell and month; the watermark lets late rows in for so long. For update or complete mode."""
    return stream.withWatermark(time, late).groupBy(cell, ym_of(F.col(time)).alias("ym")).agg(F.max(value).alias("best"), F.count("*").alias("n"))


class AlertState(StatefulProcessor):
    """One alert: its windows are kept, a month each, and folded again in order when one comes, however late."""

    def __init__(self, expiry: int = PARAMS.expiry_months):
        self.expiry = expiry

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.windows = handle.getMapState("windows", "t int", "seen boolean, back boolean, level boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        for frame in rows:
            for t, seen, back, level in frame[["t", "seen", "back", "level"]].itertuples(index=False):
                old = self.windows.getValue((int(t),)) if self.windows.containsKey((int(t),)) else (False, False, False)
                self.windows.updateValue((int(t),), tuple(bool(a) or bool(b) for a, b in zip(old, (seen, back, level), strict=True)))
        state = first = last = None
        n = 0
        windows = sorted((k[0], *v) for k, v in self.windows.iterator())
        for t, seen, back, level in windows:
            if seen:
                n, last = n + 1, t
                first = t if first is None else first
                if state is None:
                    state = "provisional"
                elif n >= 2 and last > first and not level:
                    state = "confirmada"
            elif state in ("provisional", "confirmada") and back:
                state = "descartada" if state == "provisional" else "revertida"
            elif state == "provisional" and t - last >= self.expiry:
                state = "descartada"
        if state is not None:
            yield pd.DataFrame({"alert": [key[0]], "state": [state], "first": [first], "last": [last], "n_seen": [n], "t": [windows[-1][0]]})

    def close(self) -> None:
        pass


def alert_states(windows: DataFrame, expiry: int = PARAMS.expiry_months) -> DataFrame:
    """A stream of alert, t, seen, back and, where known, level to a stream of alerts' states."""
    windows = windows if "level" in windows.columns else windows.withColumn("level", F.lit(False))
    return windows.groupBy("alert").transformWithStateInPandas(AlertState(expiry), OUTPUT, "Update", "None")


def _drained(stream: DataFrame, folder: str, mode: str) -> None:
    """Run a stream over what there is; each batch is written once under its own number."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={number}")

    stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").foreachBatch(write).trigger(availableNow=True).start().awaitTermination()


def run_to_end(spark: SparkSession, windows: DataFrame, expiry: int) -> DataFrame:
    """The last state of each alert after a stream over ``windows`` (alert, t, seen, back)."""
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    windows.write.parquet(f"{folder}/in")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    _drained(alert_states(spark.readStream.schema(windows.schema).parquet(f"{folder}/in"), expiry), folder, "update")
    seen = spark.read.schema(OUTPUT + ", batch int").parquet(f"{folder}/out")
    return seen.groupBy("alert").agg(F.max_by(F.struct("state", "first", "last", "n_seen"), "batch").alias("s")).select("alert", "s.*")


def monthly_to_end(spark: SparkSession, path: str) -> DataFrame:
    """Monthly values of the events table, read as a stream."""
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    schema = spark.read.parquet(path).schema
    rows = spark.readStream.schema(schema).parquet(path.rsplit("/", 1)[0] + "/[" + path.rsplit("/", 1)[1][0] + "]" + path.rsplit("/", 1)[1][1:]).withColumn("ts", F.col("ts").cast("timestamp"))
    _drained(monthly(rows, "ts", "user_id", "value"), folder, "complete")
    out = spark.read.parquet(f"{folder}/out")
    return out.filter(F.col("batch") == out.agg(F.max("batch")).first()[0]).drop("batch")
