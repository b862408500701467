"""Writing results."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Fixed value: text form of timestamps that keeps the microseconds.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TIME_OPTIONS = {"timestampFormat": TIME_FORMAT, "timestampNTZFormat": TIME_FORMAT}


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """CSV with a header, one file per task, optionally one folder per value."""
    writer = df.write.mode(mode).options(header=True, **TIME_OPTIONS)
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON record per line."""
    df.write.mode(mode).options(**TIME_OPTIONS).json(path)


def write_json_array(df: DataFrame, path: str) -> None:
    """One file that is one JSON array of the rows, in no order. One task writes it and holds no more than a batch of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = "["
        for b in batches:
            if b.num_rows:
                signs = pa.array([sign] + [","] * (b.num_rows - 1), b.schema.field(0).type)
                yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(signs, b.column(0), "")], ["value"])
                sign = ","
        yield pa.RecordBatch.from_arrays([pa.array(["]" if sign == "," else "[]"])], ["value"])

    as_json(df, "value").coalesce(1).mapInArrow(run, "value string").write.text(path)


def as_json(df: DataFrame, name: str = "report") -> DataFrame:
    """Each row as one JSON text."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(name))
