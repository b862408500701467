"""Reading tables by file extension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.scalar import no_nan
from tidewatch.sources.arrays import read_json_arrays

# File extension to Spark format.
FORMATS = {"csv": "csv", "json": "json", "jsonl": "json", "ndjson": "json", "parquet": "parquet"}


def format_of(path: str) -> str:
    ext = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if ext not in FORMATS:
        raise ValueError(f"unsupported format of {path!r}; one of {sorted(FORMATS)}")
    return ext


def without_nan(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating column."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: no_nan(F.col(c)) for c in floats})


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, which reads the data twice."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return without_nan(reader.csv(path))


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
              lines: bool = False) -> DataFrame:
    """An array of records, or one record per line. Both are read by as many tasks as there are shares of the files."""
    if not lines:
        return without_nan(read_json_arrays(spark, path, schema))
    reader = spark.read if schema is None else spark.read.schema(schema)
    return without_nan(reader.json(path))


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               fmt: str | None = None) -> DataFrame:
    """Reader by extension or by explicit format name; anything unknown is an error."""
    ext = fmt.lower() if fmt else format_of(path)
    if ext not in FORMATS:
        raise ValueError(f"unsupported format {ext!r}; one of {sorted(FORMATS)}")
    if FORMATS[ext] == "csv":
        return read_csv(spark, path, schema)
    if FORMATS[ext] == "json":
        return read_json(spark, path, schema, lines=ext != "json")
    return without_nan(spark.read.parquet(path))


def head(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """The first rows by an explicit order."""
    return df.orderBy(*order).limit(n)
