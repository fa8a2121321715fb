"""Landing-zone sources: listing, routing by file name, verbatim-string scans.

Bronze keeps every value as delivered text, so scans never infer types:
CSV uses the header with no inference, NDJSON keeps JSON numbers as their
source text (``primitivesAsString``), and a nested JSON object of rates is
exploded into one row per map entry.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = {".csv": "csv", ".jsonl": "ndjson", ".ndjson": "ndjson", ".json": "json"}


PARTITION_COL = "landing"


def landing_name(path: Column) -> Column:
    """Name of the landing object holding ``path``: the file name, or for a
    drop written by Spark (a folder ``landing=<name>`` of part files) the
    folder's name. Evaluated for every row read, so without patterns."""
    last_two, mark = F.substring_index(path, "/", -2), f"{PARTITION_COL}="
    folder = F.substring_index(last_two, "/", 1)
    written = folder.startswith(mark) & (F.length(folder) > len(mark)) & (F.length(last_two) < F.length(path))
    return F.when(written, F.substring(folder, len(mark) + 1, 1 << 30)).otherwise(F.substring_index(path, "/", -1))


def landing_object(path: str) -> str:
    """Python form of :func:`landing_name` for one path."""
    parts = path.rstrip("/").split("/")
    for seg in reversed(parts):
        if seg.startswith(f"{PARTITION_COL}="):
            return seg[len(PARTITION_COL) + 1:]
    return parts[-1]


def list_landing_files(spark: SparkSession, landing_dir: str, stamp: str | None = None) -> DataFrame:
    """Data files of the landing folder: (path, landing object name, length),
    sorted by path, optionally only objects whose name contains ``stamp``.
    ``binaryFile`` lists without reading content (the column is pruned)."""
    try:
        df = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
              .option("pathGlobFilter", "[!_.]*").load(landing_dir))
    except Exception as ex:  # empty or missing folder
        if "PATH_NOT_FOUND" in str(ex) or "UNABLE_TO_INFER_SCHEMA" in str(ex) or "does not exist" in str(ex):
            return spark.createDataFrame([], "path string, file_name string, length long")
        raise
    out = df.select("path", landing_name(F.col("path")).alias("file_name"), "length")
    if stamp:
        out = out.where(F.col("file_name").contains(stamp))
    return out.orderBy("path")


def list_landing_objects(spark: SparkSession, landing_dir: str, stamp: str | None = None) -> list[str]:
    """Landing objects (file paths, or ``landing=<name>`` folders of part
    files) directly under ``landing_dir``, in name order, optionally only
    names containing ``stamp``. A metadata-only listing through the Hadoop
    FileSystem (what a file source does itself); no data is read."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(landing_dir)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = []
    for st in fs.listStatus(root):
        raw = st.getPath().getName()
        if raw.startswith(("_", ".")):
            continue
        if st.isDirectory():
            if not raw.startswith(f"{PARTITION_COL}="):
                continue
            name = landing_object(st.getPath().toString())
        else:
            name = raw
        if stamp is None or stamp in name:
            found.append((name, st.getPath().toString()))
    return [p for _, p in sorted(found)]


def source_of(name: str, sources: Sequence[str]) -> str:
    """``customers_20260701.csv`` -> ``customers``; unknown names raise."""
    base = landing_object(name)
    for s in sorted(sources, key=len, reverse=True):
        if base.startswith(f"{s}_"):
            return s
    raise ValueError(f"{base}: no known source begins with this name")


def source_col(file_name: Column, sources: Sequence[str]) -> Column:
    """Column form of :func:`source_of`; unknown names fail the query."""
    alts = "|".join(sorted(sources, key=len, reverse=True))
    s = F.regexp_extract(file_name, f"^({alts})_", 1)
    return F.when(s != "", s).otherwise(
        F.raise_error(F.concat(file_name, F.lit(": no known source begins with this name"))))


def format_of(name: str) -> str:
    base = landing_object(name)
    for suffix, fmt in FORMATS.items():
        if base.endswith(suffix):
            return fmt
    raise ValueError(f"{base}: landing objects end in {', '.join(FORMATS)}")


def file_name_col() -> Column:
    return landing_name(F.col("_metadata.file_path"))


def _strings(df: DataFrame) -> DataFrame:
    cols = [c for c in df.columns if c != PARTITION_COL]
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in cols],
                     file_name_col().alias("_source_file"))


def read_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """CSV with header, every column a string, plus ``_source_file``.

    All ``paths`` must share one header: Spark binds CSV columns by position
    (see :func:`read_csv_grouped` for mixed headers)."""
    df = csv_options(spark.read.option("inferSchema", False)).csv(list(paths) if not isinstance(paths, str) else paths)
    return _strings(df)


def csv_options(reader):
    """CSV as producers write it: a header, quotes doubled inside quoted values,
    values that hold line breaks, blanks kept, bad records refused."""
    return (reader.option("header", True).option("mode", "FAILFAST").option("quote", '"').option("escape", '"')
            .option("multiLine", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The files of a landing object: itself, or a folder's parts in name order."""
    return list(data_file_sizes(spark, path))


def data_file_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """:func:`data_files` with their bytes."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    top = fs.getFileStatus(p)
    if not top.isDirectory():
        return {path: top.getLen()}
    return dict(sorted((str(st.getPath().toString()), st.getLen()) for st in fs.listStatus(p)
                       if st.isFile() and not st.getPath().getName().startswith(("_", "."))))


def csv_header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of a CSV file: its first record, read through the Hadoop
    FileSystem (quoted names may hold commas and line breaks), and through the
    codec that the file's suffix stands for."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    raw = p.getFileSystem(conf).open(p)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(raw if codec is None else codec.createInputStream(raw), "UTF-8"))
    try:
        text = (reader.readLine() or "").lstrip("\ufeff")
        while text.count('"') % 2:
            more = reader.readLine()
            if more is None:
                break
            text += "\n" + more
    finally:
        reader.close()
    return tuple(next(csv.reader(io.StringIO(text)), []))


def csv_headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, tuple[str, ...]]:
    """Header of every file, some at a time (each is one small remote read)."""
    with ThreadPoolExecutor(16) as pool:
        return dict(zip(paths, pool.map(lambda p: csv_header(spark, p), paths)))


def read_csv_grouped(spark: SparkSession, paths: Sequence[str], contract: Sequence[str]) -> DataFrame:
    """Many CSV files with possibly different headers: one read per distinct
    header (never positional binding across headers), each aligned to the
    contract by name, then unioned."""
    from tierflow.sources.contracts import align
    groups: dict[tuple[str, ...], list[str]] = {}
    for f, header in csv_headers(spark, [f for p in paths for f in data_files(spark, p)]).items():
        groups.setdefault(header, []).append(f)
    parts = [align(read_csv(spark, ps), contract, keep=("_source_file",)) for ps in groups.values()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_ndjson(spark: SparkSession, paths: str | Sequence[str], schema=None) -> DataFrame:
    """Newline-delimited JSON as verbatim strings (``100.0``, ``1e3`` and
    20-digit integers keep their text); malformed lines fail the read."""
    r = spark.read.option("primitivesAsString", True).option("mode", "FAILFAST")
    if schema is not None:
        r = r.schema(schema)
    df = r.json(list(paths) if not isinstance(paths, str) else paths)
    return _strings(df)


def read_json_map(spark: SparkSession, paths: str | Sequence[str], *, date_field: str = "date",
                  map_field: str = "rates_to_bob", out: Mapping[str, str] | None = None) -> DataFrame:
    """A JSON document ``{date, <map>: {k: v}}`` -> one row per map entry,
    the date repeated: (rate_date, currency, rate_to_bob) by default. A document
    without the date or the map fails the read."""
    names = dict(out or {"date": "rate_date", "key": "currency", "value": "rate_to_bob"})
    schema = f"`{date_field}` string, `{map_field}` map<string,string>"
    df = spark.read.option("multiLine", True).option("mode", "FAILFAST").schema(schema).json(
        list(paths) if not isinstance(paths, str) else paths)
    def needed(name: str) -> Column:
        text = F.concat(F.lit(f"no field {name} in "), file_name_col())
        return F.when(F.col(f"`{name}`").isNull(), F.raise_error(text)).otherwise(F.col(f"`{name}`"))

    return df.select(needed(date_field).alias(names["date"]),
                     F.explode(needed(map_field)).alias(names["key"], names["value"]),
                     file_name_col().alias("_source_file"))


def read_landing(spark: SparkSession, path: str, *, json_map: Mapping | None = None) -> DataFrame:
    """One landing file by suffix; unsupported suffixes raise."""
    fmt = format_of(path)
    if fmt == "csv":
        return read_csv(spark, path)
    if fmt == "ndjson":
        return read_ndjson(spark, path)
    return read_json_map(spark, path, **(json_map or {}))
