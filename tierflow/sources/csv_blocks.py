"""Large CSV files read by many tasks, line breaks inside quotes included.

Spark's CSV reader gives a file whose values may hold line breaks to one task.
Here the file's lines are read by blocks, as text. A quote toggles between inside
and outside, so whether a line begins inside a quoted value follows from the
number of quotes before it: in its block, and in the blocks before (one small row
a block). Lines that begin outside begin a record; the others continue one.
Blocks without a line that leaves a value open need no shuffle.

This holds for files that quote as RFC 4180 says. A line that shows otherwise (a
quote amid a plain value, or a value still open at the end, or lines that end in
a carriage return alone) is found, and its file is left to Spark's reader, whole.
Where a file's first line ends in carriage return and line feed, these two are one
line break wherever they are, as for Spark's reader.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierflow.session import work_dir
from tierflow.sources.contracts import align
from tierflow.sources.landing import landing_name

# The options of `landing.csv_options`, for a record by itself.
RECORD_OPTIONS = {"mode": "FAILFAST", "quote": '"', "escape": '"', "multiLine": "true",
                  "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """``(file, block, pos, open, text)``: every line, the place of its block in
    the file, its place in the block (by order alone), and 1 if it has an odd
    number of quotes. Written once: what reads it sees the same blocks, whatever
    executors there are by then."""
    raw = spark.read.option("lineSep", "\n").text(list(files))
    text = F.col("value")
    quotes = F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))
    return _staged(raw.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"), F.pmod(quotes, F.lit(2)).alias("open"), text.alias("text")), "csv-lines")


def _stray(text: Column, inside: Column) -> Column:
    """Whether a line, which begins ``inside`` (1) a quoted value or outside (0),
    has a quote where none may be. Between quotes, the pieces outside lie next to
    commas, or are empty: a doubled quote."""
    pieces = F.split(text, '"')
    last = F.size(pieces) - 1

    def wrong(piece: Column, i: Column) -> Column:
        before = (i == 0) | piece.startswith(",") | (piece == "")
        after = (i == last) | piece.endswith(",") | (piece == "")
        return (F.pmod(i + inside, F.lit(2)) == 0) & ~(before & after)
    found = F.size(F.filter(F.transform(pieces, wrong), lambda x: x)) > 0
    return F.when(text.contains('"'), found).otherwise(F.lit(False))


def _marked(lines: DataFrame) -> DataFrame:
    """Lines with ``record`` (the place of the line that its record begins with)
    and ``stray``."""
    blocks = lines.groupBy("file", "block").agg(F.sum("open").alias("opens"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("inside", F.pmod(F.coalesce(F.sum("opens").over(earlier), F.lit(0)), F.lit(2)))
    place, text = F.struct("block", "pos"), F.col("text")
    first = lines.groupBy("file").agg(F.min_by("text", place).alias("first"))
    first = first.select("file", F.endswith("first", F.lit("\r")).alias("two"),
                         F.locate("\r", "first").between(1, F.length("first") - 1).alias("other"))
    known = lines.join(blocks.join(first, "file"), ["file", "block"])
    known = known.withColumn("text", F.when(F.col("two") & text.endswith("\r"), F.left(text, F.length(text) - 1)).otherwise(text))
    plain = known.where("opens = 0 AND inside = 0").select(
        "file", "block", "pos", "open", "text", place.alias("record"), (F.col("other") | _stray(text, F.lit(0))).alias("stray"))
    order = Window.partitionBy("file", "block").orderBy("pos")
    mixed = known.where("opens > 0 OR inside = 1").withColumn(
        "inside", F.pmod(F.col("inside") + F.sum("open").over(order) - F.col("open"), F.lit(2)))
    mixed = mixed.withColumn("begun", F.max(F.when(F.col("inside") == 0, place)).over(order))
    # a block that begins inside goes on with the last record begun before it
    last = mixed.groupBy("file", "block").agg(F.max("begun").alias("last"))
    carried = last.select("file", "block", F.max("last").over(earlier).alias("carried"))
    mixed = mixed.join(carried, ["file", "block"]).select(
        "file", "block", "pos", "open", "text", F.coalesce("begun", "carried").alias("record"),
        (F.col("other") | _stray(text, F.col("inside"))).alias("stray"))
    return plain.unionByName(mixed)


@dataclass
class CsvRecords:
    """``rows``: ``(file, record, text)``, one row a record, header and empty lines
    left out; ``headers``: file -> names; ``whole``: files that have to be read by
    one task each."""

    rows: DataFrame
    headers: dict[str, tuple[str, ...]]
    whole: list[str]


def csv_records(spark: SparkSession, files: Sequence[str]) -> CsvRecords:
    """The records of CSV files, as text. The driver gets one row a file."""
    lines = text_lines(spark, files)
    marked = _staged(_marked(lines), "csv-marked")
    per_file = marked.groupBy("file").agg(F.max("stray").alias("stray"), F.pmod(F.sum("open"), F.lit(2)).alias("left"))
    odd = per_file.where("stray OR left = 1").select("file")
    good = marked.join(odd, "file", "left_anti")
    alone = (F.col("record.block") == F.col("block")) & (F.col("record.pos") == F.col("pos")) & (F.col("open") == 0)
    one = good.where(alone).select("file", "record", "text")
    # the lines of one record: a value with line breaks, never more than a row
    more = good.where(~alone).groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("block", "pos", "text"))).alias("parts"))
    more = more.select("file", "record", F.array_join(F.col("parts.text"), "\n").alias("text"))
    records = one.unionByName(more).where("text <> ''")
    records = _staged(records, "csv-records")
    first = records.groupBy("file").agg(F.min("record").alias("head"), F.min_by("text", "record").alias("header"))
    headers = {r["file"]: _names(r["header"]) for r in first.select("file", "header").collect()}
    rows = records.join(first.select("file", "head"), "file").where("record > head").select("file", "record", "text")
    return CsvRecords(rows, headers, [r["file"] for r in odd.collect()])


def _names(header: str) -> tuple[str, ...]:
    return tuple(next(csv.reader(io.StringIO(header.lstrip("\ufeff"), newline="")), []))


def parse_records(found: CsvRecords, names: Sequence[str], files: Sequence[str] | None = None) -> DataFrame:
    """The records of the files with this header (of ``files``, if given), every
    column as text, and ``_source_file``; a record with more or fewer values fails
    the read."""
    mine = [(f,) for f, h in found.headers.items() if h == tuple(names) and (files is None or f in files)]
    mine = found.rows.sparkSession.createDataFrame(mine, "file string")
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    rows = found.rows.join(mine, "file").select("file", F.from_csv("text", schema, RECORD_OPTIONS).alias("r"))
    return rows.select(*[F.col(f"r.c{i}").alias(n) for i, n in enumerate(names)], landing_name(F.col("file")).alias("_source_file"))


def split_bytes(spark: SparkSession) -> int:
    """Files up to this size are one task's work anyway."""
    return int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())


def read_csv_blocks(spark: SparkSession, files: Sequence[str], contract: Sequence[str]) -> DataFrame:
    """CSV files cut into blocks, each bound to the contract by the names of its
    own header: what :func:`~tierflow.sources.landing.read_csv_grouped` gives."""
    from tierflow.sources.landing import read_csv_grouped
    found = csv_records(spark, files)
    parts = [align(parse_records(found, h), contract, keep=("_source_file",)) for h in sorted(set(found.headers.values()))]
    if found.whole:
        parts.append(read_csv_grouped(spark, found.whole, contract))
    out = parts[0] if parts else align(spark.createDataFrame([], "_source_file string"), contract, keep=("_source_file",))
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
