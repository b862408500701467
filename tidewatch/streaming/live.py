"""Live versions of the grid and of the threshold rules."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tidewatch.functions.constants import THRESHOLD_RULES
from tidewatch.functions.scalar import epoch_us, no_nan
from tidewatch.operators.grid import FREQUENCIES, MINUTE, frequency
from tidewatch.plans.staging import staging_path


def read_stream(spark: SparkSession, path: str, schema: T.StructType, ts: str, fmt: str = "parquet",
                glob: str | None = None, files_per_trigger: int | None = None) -> DataFrame:
    """A folder as a stream; ``ts`` becomes TIMESTAMP, as watermarks need it."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(fmt).load(path).withColumn(ts, F.col(ts).cast("timestamp"))


def resample_stream(stream: DataFrame, keys: Sequence[str], ts: str, value: str, freq: str = "1h",
                    late: str = "10 minutes") -> DataFrame:
    """Mean and count per bin, emitted once the watermark has passed the bin; later rows are dropped."""
    width = f"{FREQUENCIES[frequency(freq)] // MINUTE} minutes"
    return (
        stream.withWatermark(ts, late).groupBy(*keys, F.window(ts, width).alias("_bin"))
        .agg(F.avg(no_nan(F.col(value).cast("double"))).alias(value), F.count(F.lit(1)).alias("n"))
        .select(*keys, F.col("_bin.start").alias(ts), value, "n"))


def alert_stream(stream: DataFrame, metric: str, value: str, rules=THRESHOLD_RULES) -> DataFrame:
    """Readings outside their metric's range, at once, with reason and severity. No state: rules that ask
    for several readings in a row are left to ``run_sustained_alerts``."""
    rules = [r for r in rules if not r[4]]
    v, m = F.col(value).cast("double"), F.col(metric)
    reason, severity = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, label, low, high, _ in rules:
        above, below = (m == name) & (v > F.lit(float(high))), (m == name) & (v < F.lit(float(low)))
        reason = F.when(below, f"{label} < {low}").when(above, f"{label} > {high}").otherwise(reason)
        severity = F.when(below, "high").when(above, "medium").otherwise(severity)
    return stream.withColumns({"threshold_reason": reason, "threshold_severity": severity}).filter(
        F.col("threshold_reason").isNotNull())


def run_to_table(stream: DataFrame, out: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process everything available into parquet files and return them as a table."""
    spark = stream.sparkSession
    out = out or staging_path(spark, "stream-out")
    query = (
        stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
        .option("path", out).option("checkpointLocation", checkpoint or staging_path(spark, "stream-state")).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CARRIED = "t array<bigint>, o array<string>, above array<boolean>, below array<boolean>"


def _run_lengths(hit: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many readings in a row, up to and with each one, are hits; a start begins anew."""
    at = np.arange(len(hit))
    fresh = np.maximum.accumulate(np.where(starts, at, 0))
    miss = np.maximum.accumulate(np.where(~hit, at + 1, 0))
    return np.where(hit, at - np.maximum(fresh, miss) + 1, 0)


class _Runs(StatefulProcessor):
    """Per series the last readings that a run can need; a batch's readings are judged among them in order of time."""

    def __init__(self, names: list[str], reach: int, idle_us: int | None):
        self.names, self.reach, self.idle_us = names, reach, idle_us

    def init(self, handle) -> None:
        self.handle = handle
        self.tail = handle.getValueState("tail", CARRIED)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        kept = self.tail.get() if self.tail.exists() else ([], [], [], [])
        t = np.concatenate((np.array(list(kept[0]), np.int64), new["at"].to_numpy(np.int64)))
        o = np.concatenate((np.array(list(kept[1]), object), new["tie"].to_numpy(object)))
        above = np.concatenate((np.array(list(kept[2]), bool), new["above"].to_numpy(bool)))
        below = np.concatenate((np.array(list(kept[3]), bool), new["below"].to_numpy(bool)))
        order = np.lexsort((o.astype(str), t))
        t, o, above, below = t[order], o[order], above[order], below[order]
        starts = np.zeros(len(t), bool)
        starts[:1] = True
        if self.idle_us is not None:
            starts[1:] |= np.diff(t) > self.idle_us
        up, down = _run_lengths(above, starts), _run_lengths(below, starts)
        if self.reach:
            tail = slice(max(0, len(t) - self.reach), None)
            self.tail.update((t[tail].tolist(), o[tail].tolist(), above[tail].tolist(), below[tail].tolist()))
            if self.idle_us is not None:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(int((t[-1] + self.idle_us) // 1000 + 1))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        mine = place[len(order) - len(new):]
        hit = (up[mine] > 0) | (down[mine] > 0)
        out = new.loc[hit, self.names]
        yield out.assign(up=up[mine][hit], down=down[mine][hit])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.tail.clear()
        yield from ()

    def close(self) -> None:
        pass


def sustained_alert_stream(stream: DataFrame, keys: Sequence[str], metric: str, ts: str, value: str, order: Sequence[str] = (),
                           rules=THRESHOLD_RULES, idle: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Rules over k consecutive readings as a stream of alerts, with the state of each series under its key.

    Of a series the last k - 1 readings are kept, which is all a run can need; a micro-batch reads and writes the state of the
    series that it brings readings of, and no other. A reading that arrives after later ones of its series is judged among the
    carried readings in order of time, ties by ``order``; alerts already given stay. A reading whose value is missing ends a run; one without a time is left out.

    Without ``idle`` nothing is ever forgotten, and the alerts are those of the batch operator. With it a run ends at a gap
    longer than ``idle``, readings later than ``late`` are dropped, and a timer in event time removes the state of a series once
    the watermark has passed its last reading by ``idle``. The readings that a micro-batch has of one series are sorted in one task:
    the trigger bounds them. Needs the RocksDB state store, which ``run_sustained_alerts`` chooses.
    """
    keys, names = list(keys), stream.columns
    reach = max([k for *_, k in rules] + [1]) - 1
    v, m = F.col(value).cast("double"), F.col(metric)
    above, below = F.lit(False), F.lit(False)
    for name, _, low, high, _ in rules:
        above = above | ((m == name) & (v > F.lit(float(high))))
        below = below | ((m == name) & (v < F.lit(float(low))))
    tie = F.concat_ws("\x1f", *[_sortable(stream.schema[c].dataType, F.col(c)) for c in order]) if order else F.lit("")
    # the rows of a processor are named tuples, so columns go by names that these may have
    plain = {c: f"c{i}" for i, c in enumerate(names)}
    marked = stream.filter(F.col(ts).isNotNull()).select(
        *[F.col(f"`{c}`").alias(n) for c, n in plain.items()], epoch_us(F.col(ts)).alias("at"), tie.alias("tie"),
        F.coalesce(above, F.lit(False)).alias("above"), F.coalesce(below, F.lit(False)).alias("below"), F.lit(0).alias("one"))
    idle_us = None
    if idle is not None:
        marked = marked.withWatermark(plain[ts], late)
        idle_us = int(pd.Timedelta(idle) / pd.Timedelta("1us"))
    out = T.StructType([*[T.StructField(plain[f.name], f.dataType) for f in stream.schema], T.StructField("up", T.LongType()), T.StructField("down", T.LongType())])
    runs = (marked.groupBy(*([plain[k] for k in keys] or ["one"]))
            .transformWithStateInPandas(_Runs(list(plain.values()), reach, idle_us), out, "append", "None" if idle is None else "EventTime"))
    m, v = F.col(plain[metric]), F.col(plain[value]).cast("double")
    reason, severity = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, label, low, high, k in rules:
        note, sev_up, sev_down = (" (sustained)", "high", "medium") if k > 0 else ("", "medium", "high")
        up, down = (m == name) & (F.col("up") >= max(k, 1)), (m == name) & (F.col("down") >= max(k, 1))
        if k == 0:
            up, down = up & (v > F.lit(float(high))), down & (v < F.lit(float(low)))
        reason = F.when(down, f"{label} < {low}{note}").when(up, f"{label} > {high}{note}").otherwise(reason)
        severity = F.when(down, sev_down).when(up, sev_up).otherwise(severity)
    return runs.select(*[F.col(n).alias(c) for c, n in plain.items()], reason.alias("threshold_reason"), severity.alias("threshold_severity")).filter(
        F.col("threshold_reason").isNotNull())


def _sortable(kind: T.DataType, c: Column) -> Column:
    """A text that sorts like the column: whole numbers are shifted above zero and padded. Null comes first."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        n = c.cast("decimal(20,0)")
        return F.coalesce(F.lpad((n + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string"), 20, "0"), F.lit(""))
    return F.coalesce(c.cast("string"), F.lit(""))


def run_sustained_alerts(stream: DataFrame, keys: Sequence[str], metric: str, ts: str, value: str,
                         order: Sequence[str] = (), rules=THRESHOLD_RULES, out: str | None = None,
                         checkpoint: str | None = None, idle: str | None = None, late: str = "10 minutes") -> DataFrame:
    """X3 over everything available: the alerts as a table. With ``out`` and ``checkpoint`` a later call goes on where this one ended."""
    spark, setting = stream.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    was = spark.conf.get(setting)
    spark.conf.set(setting, ROCKSDB)
    try:
        return run_to_table(sustained_alert_stream(stream, keys, metric, ts, value, order, rules, idle, late), out, checkpoint)
    finally:
        spark.conf.set(setting, was)
