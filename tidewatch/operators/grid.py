"""Regular time grids: resampling with empty bins, conforming, future steps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.scalar import epoch_us, floor_div, from_epoch_us, long, no_nan
from tidewatch.operators.fill import METHODS, carried_points, edge_points, filled, nearest_points
from tidewatch.plans.chunks import CHUNK_ROWS, attach, to_chunks

MINUTE = 60_000_000
DAY = 1440 * MINUTE

# Supported frequencies in microseconds.
FREQUENCIES = {
    "1min": MINUTE,
    "5min": 5 * MINUTE,
    "15min": 15 * MINUTE,
    "30min": 30 * MINUTE,
    "1h": 60 * MINUTE,
    "1D": DAY,
    "1W": 7 * DAY,
}
# Older spellings of the same frequencies.
ALIASES = {"1T": "1min", "T": "1min", "5T": "5min", "15T": "15min", "30T": "30min", "1H": "1h", "H": "1h",
           "D": "1D", "W": "1W"}


def frequency(freq: str) -> str:
    name = ALIASES.get(freq, freq)
    if name not in FREQUENCIES:
        raise ValueError(f"unknown frequency {freq!r}; one of {sorted(FREQUENCIES)}")
    return name


def _bin_number(us: Column, freq: str) -> Column:
    """Number of the bin holding an instant. Weeks run Monday to Sunday."""
    return floor_div(us + F.lit(3 * DAY) if freq == "1W" else us, FREQUENCIES[freq])


def _bin_label(number: Column, freq: str) -> Column:
    """Label of a bin in microseconds: its start, for weeks the closing Sunday."""
    start = number * F.lit(FREQUENCIES[freq])
    return start + F.lit(3 * DAY) if freq == "1W" else start


def bin_label(ts: Column, freq: str, like) -> Column:
    """Label of the bin of a timestamp column."""
    freq = frequency(freq)
    return from_epoch_us(_bin_label(_bin_number(epoch_us(ts), freq), freq), like)


def _dense(observed: DataFrame, keys: list[str], cols: list[str], methods: Mapping[str, str],
           chunk_rows: int) -> DataFrame:
    """Emit every bin between the first and last of each series.

    Each observed bin is followed by the empty bins up to the next observed one, so no
    grid is joined. Fills need only the observed rows: an empty bin takes its neighbours
    from the observed bin before it. One shuffle of observed bins to (series, chunk).
    """
    carry_cols = [c for c in cols if methods.get(c, "none") not in ("none", "zero")]
    base, key = to_chunks(observed, keys, "_bin", chunk_rows)
    over_chunks = Window.partitionBy(*key).orderBy("_chunk")
    spans = (
        base.groupBy(*key, "_chunk").agg(F.min("_bin").alias("_lo"), *edge_points("_bin", carry_cols))
        .select(
            *key, "_chunk",
            F.lead("_lo").over(over_chunks).alias("_next_lo"),
            F.first("_lo").over(over_chunks.rowsBetween(Window.unboundedPreceding, 0)).alias("_first"),
            *[c.alias(n) for n, c in carried_points(key, carry_cols).items()],
        )
    )
    in_chunk = Window.partitionBy(*key, "_chunk").orderBy("_bin")
    near = base.join(spans, on=[*key, "_chunk"]).withColumns({
        "_until": F.coalesce(F.lead("_bin").over(in_chunk), F.col("_next_lo"), F.col("_bin") + 1) - 1,
        # "after": the nearest later point of the empty bins that follow this observed bin
        **nearest_points(key, "_bin", carry_cols, strictly_after=True),
    })
    # Two levels, so that no row ever carries an array longer than a chunk.
    span = F.lit(chunk_rows).cast("bigint")
    first_block, last_block = floor_div(F.col("_bin"), chunk_rows), floor_div(F.col("_until"), chunk_rows)
    blocks = near.withColumn("_block", F.explode(F.sequence(first_block, last_block)))
    lo = F.greatest(F.col("_bin"), F.col("_block") * span)
    hi = F.least(F.col("_until"), (F.col("_block") + 1) * span - 1)
    rows = blocks.withColumn("_at", F.explode(F.sequence(lo, hi)))
    seen = F.col("_at") == F.col("_bin")
    values = []
    for c in cols:
        value = F.when(seen, F.col(c))
        method = methods.get(c, "none")
        if c in carry_cols:
            nxt = F.when(seen, F.col(f"_next_{c}")).otherwise(F.col(f"_after_{c}"))
            value = filled(value, F.col("_at"), F.col(f"_prev_{c}"), nxt, method)
        elif method == "zero":
            value = F.coalesce(value, F.lit(0).cast(observed.schema[c].dataType))
        values.append(value.alias(c))
    return rows.select(*keys, F.col("_at").alias("_bin"), (F.col("_at") - F.col("_first")).alias("pos"), *values)


def resample(df: DataFrame, keys: Sequence[str], ts: str, freq: str, aggs: Mapping[str, Column],
             fill: str | Mapping[str, str] = "none", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Aggregate each series into bins of ``freq`` and emit all bins from its first to
    its last, filled by ``fill`` (one method, or one per column).

    Returns keys, ``ts`` (bin label), ``pos`` (0-based bin position) and the aggregates.
    """
    freq, keys = frequency(freq), list(keys)
    methods = dict(fill) if isinstance(fill, Mapping) else dict.fromkeys(aggs, fill)
    if bad := set(methods.values()) - set(METHODS):
        raise ValueError(f"unknown fill methods {sorted(bad)}; choose from {METHODS}")
    like = df.schema[ts].dataType
    observed = (
        df.filter(F.col(ts).isNotNull())
        .groupBy(*keys, _bin_number(epoch_us(F.col(ts)), freq).alias("_bin"))
        .agg(*[c.alias(name) for name, c in aggs.items()])
    )
    dense = _dense(observed, keys, list(aggs), methods, chunk_rows)
    label = from_epoch_us(_bin_label(F.col("_bin"), freq), like)
    return dense.select(*keys, label.alias(ts), "pos", *aggs)


def resample_mean(df, keys, ts, value, freq="1h", fill="none", **kw) -> DataFrame:
    """Mean per bin; empty bins NULL unless filled."""
    return resample(df, keys, ts, freq, {value: F.avg(no_nan(F.col(value).cast("double")))}, fill, **kw)


def resample_sum(df, keys, ts, value, freq="5min", **kw) -> DataFrame:
    """Sum per bin; empty bins 0."""
    total = F.coalesce(F.sum(F.col(value).cast("double")), F.lit(0.0))
    return resample(df, keys, ts, freq, {value: total}, "zero", **kw)


def first_present(col: str, ts: str, tie: str | None = None) -> Column:
    """First non-null value by time; ``tie`` decides between equal timestamps."""
    order = F.struct(F.col(ts), F.col(tie)) if tie else F.col(ts)
    return F.min_by(F.col(col), F.when(F.col(col).isNotNull(), order))


def resample_mixed(df: DataFrame, keys: Sequence[str], ts: str, freq: str, numeric: Sequence[str],
                   other: Sequence[str] = (), fill: str = "interpolate_both", tie: str | None = None,
                   **kw) -> DataFrame:
    """Numeric columns by mean, others by first non-null, then one fill method.

    interpolation and zero apply to numeric columns only; ffill and bfill to all.
    """
    if fill == "interpolate":
        fill = "interpolate_both"
    aggs = {c: F.avg(no_nan(F.col(c).cast("double"))) for c in numeric}
    aggs |= {c: first_present(c, ts, tie) for c in other}
    for_other = fill if fill in ("ffill", "bfill") else "none"
    methods = dict.fromkeys(numeric, fill) | dict.fromkeys(other, for_other)
    return resample(df, keys, ts, freq, aggs, methods, **kw)


def daily_sum(df: DataFrame, keys: Sequence[str], ts: str, value: str) -> DataFrame:
    """Sum per calendar day, only days present."""
    day = bin_label(F.col(ts), "1D", df.schema[ts].dataType)
    return df.filter(F.col(ts).isNotNull()).groupBy(*keys, day.alias(ts)).agg(
        F.sum(F.col(value).cast("double")).alias(value))


def daily_count(df: DataFrame, keys: Sequence[str], ts: str, flag: str, name: str = "anomalies", **kw) -> DataFrame:
    """Flagged rows per day, zero days included."""
    hits = F.sum(F.coalesce(F.col(flag), F.lit(False)).cast("bigint"))
    return resample(df, keys, ts, "1D", {name: hits}, "zero", **kw)


def conform(df: DataFrame, keys: Sequence[str], ts: str, cols: Sequence[str], freq: str = "1min",
            fill: str = "none", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Place readings on the grid that starts at each series' first timestamp.

    Nothing is aggregated: readings off the grid are left out, empty steps are NULL.
    Two readings of a series at one timestamp are an error, as they would have no one place.
    """
    step, keys = FREQUENCIES[frequency(freq)], list(keys)
    like = df.schema[ts].dataType
    us = df.filter(F.col(ts).isNotNull()).withColumn("_us", epoch_us(F.col(ts)))
    anchored = attach(us, us.groupBy(*keys).agg(F.min("_us").alias("_start")), keys)
    phase = F.pmod(F.col("_start"), F.lit(step))
    observed = (
        anchored.withColumn("_phase", phase)
        .filter(F.pmod(F.col("_us") - F.col("_phase"), F.lit(step)) == 0)
        .groupBy(*keys, "_phase", floor_div(F.col("_us") - F.col("_phase"), step).alias("_bin"))
        .agg(*[F.first(c).alias(c) for c in cols], F.count(F.lit(1)).alias("_n"))
        .withColumns({c: F.when(F.col("_n") == 1, F.col(c)).otherwise(
            F.raise_error(F.lit("two readings at one timestamp")).cast(df.schema[c].dataType)) for c in cols})
    )
    dense = _dense(observed, [*keys, "_phase"], list(cols), dict.fromkeys(cols, fill), chunk_rows)
    label = from_epoch_us(F.col("_bin") * F.lit(step) + F.col("_phase"), like)
    return dense.select(*keys, label.alias(ts), "pos", *cols)


def future_steps(df: DataFrame, keys: Sequence[str], ts: str, hours: int, freq: str = "1min",
                 history: bool = True) -> DataFrame:
    """The steps of ``freq`` covering ``hours`` after each series' last timestamp,
    with the distinct history timestamps before them if asked. ``is_future`` tells them apart."""
    keys = list(keys)
    like, step = df.schema[ts].dataType, FREQUENCIES[frequency(freq)]
    steps = hours * 60 * MINUTE // step
    last = df.groupBy(*keys).agg(F.max(epoch_us(F.col(ts))).alias("_last"))
    ahead = last.withColumn("_k", F.explode(F.sequence(long(1), long(steps)))).select(
        *keys, from_epoch_us(F.col("_last") + F.col("_k") * F.lit(step), like).alias(ts), F.lit(True).alias("is_future"))
    if not history:
        return ahead
    return df.select(*keys, ts).distinct().withColumn("is_future", F.lit(False)).unionByName(ahead)
