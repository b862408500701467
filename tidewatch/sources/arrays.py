"""Files that are one JSON array of records, read by many tasks.

A parser of a whole array has to start at its first byte. Here the file is cut behind every closing brace, wherever
tasks' shares of it begin, and each piece tells what it does to the parser: how many unescaped quotes it
has, and how it moves the depth of braces and brackets if it starts outside a string or inside one. Sums of these over the
shares of a file, one row per share, give the state in which each share starts, and so where records end. A share has at most
2 ** ``SHARE_BITS`` pieces, and a task some ``SHARES`` shares, however large the file is. Records become lines, which Spark's JSON reader takes in any number of tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.plans.staging import scratch, stage, staging_path

SHARE_BITS = 15
SHARES = 4  # shares of a task


def _depth(text: Column) -> Column:
    """Opening less closing braces and brackets."""
    return F.length(F.regexp_replace(text, r"[^{\[]", "")) - F.length(F.regexp_replace(text, r"[^}\]]", ""))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Pieces (file, block, id, value) up to a closing brace, the quotes in each, its moves (from outside, from inside a string), and whether it has an
    opening brace; dealt out by their shares, which ``block`` names in their order in the file."""
    rows = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id"), "value")
    rows = rows.withColumn("block", F.struct("start", F.shiftright("id", SHARE_BITS).alias("share"))).drop("start")
    parts = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"', -1)
    side = lambda k: F.array_join(F.filter(parts, lambda s, i: i % 2 == k), "")
    quotes = (F.size(parts) - 1).cast("long")
    even = F.when(quotes % 2 == 0, 1).otherwise(0)  # the brace behind the piece counts if it is outside a string
    told = rows.select("*", quotes.alias("quotes"), (_depth(side(0)) - even).cast("long").alias("outside"), (_depth(side(1)) - (1 - even)).cast("long").alias("inside"),
                       (F.instr("value", "{") > 0).alias("opens"))
    told = stage(told, "pieces")
    shares = told.select("file", "block").distinct().count()
    return told.repartition(max(1, -(-shares // SHARES)), "file", "block")


def _before(rows: DataFrame, column: str) -> DataFrame:
    """``column`` summed over all that precedes in the file, as {column}_before, and over the file's earlier shares, as {column}_at."""
    here = Window.partitionBy("file", "block").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    shares = rows.groupBy(F.col("file").alias("_f"), F.col("block").alias("_b")).agg(F.sum(column).alias("_s"))
    earlier = Window.partitionBy("_f").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # a row per share of a file
    at = shares.select("_f", "_b", F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias(f"{column}_at"))
    out = rows.withColumn("_here", F.coalesce(F.sum(column).over(here), F.lit(0))).join(at, (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b")))
    return out.withColumn(f"{column}_before", F.col(f"{column}_at") + F.col("_here")).drop("_f", "_b", "_here")


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of array files as text (``record``), one row each, in no order.

    Records are the objects of the outermost array, or the file's objects if it isn't an array; anything else between them is left
    out. Braces, brackets and quotes inside strings are text. What an unfinished file has after its last whole record is left out.
    """
    pieces = _before(_pieces(spark, path), "quotes")
    start = F.col("quotes_before") % 2
    moved = pieces.withColumns({"moves": F.when(start == 0, F.col("outside")).otherwise(F.col("inside")), "open": (start + F.col("quotes")) % 2 == 1})
    first = moved.groupBy(F.col("file").alias("_file")).agg(F.min_by("value", F.struct("block", "id")).alias("_v"))
    base = first.select("_file", F.when(F.ltrim(F.regexp_replace("_v", r"^[\s﻿]+", "")).startswith("["), 1).otherwise(0).alias("base"))
    deep = _before(moved, "moves").join(base, F.col("file") == F.col("_file")).drop("_file")
    ends = (~F.col("open") & (F.col("moves_before") + F.col("moves") == F.col("base")) & (F.col("opens") | (F.col("moves_before") > F.col("base"))))
    told = _before(deep.withColumn("ends", ends.cast("long")), "ends")
    inner = F.col("ends_before") - F.col("ends_at")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "value"))), lambda p: F.concat(p["value"], F.lit("}"))), "")
    parts = told.groupBy("file", "block", F.col("ends_before").alias("n")).agg(
        text.alias("text"), (F.max("ends") == 1).alias("whole"), F.max((inner == 0) & (F.col("moves_at") > F.col("base"))).alias("goes_on"))
    parts = stage(parts, "records")
    joined = (parts.filter("goes_on or not whole").groupBy("file", "n").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("p"), F.max("whole").alias("whole"))
              .filter("whole").select(F.array_join(F.transform("p", lambda x: x["text"]), "").alias("text")))
    every = parts.filter("whole and not goes_on").select("text").unionByName(joined)
    return every.select(F.regexp_replace(F.regexp_replace("text", r"(?s)^[^{]*", ""), r"[\r\n]", " ").alias("record"))


def read_json_arrays(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Array files as a table; without a schema its types are inferred from all records."""
    lines = staging_path(spark, "json-lines", keep=True)
    with scratch(spark):
        array_records(spark, path).write.text(lines)
    return (spark.read if schema is None else spark.read.schema(schema)).json(lines)
