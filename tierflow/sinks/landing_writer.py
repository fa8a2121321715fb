"""Export a DataFrame as landing objects (the producer side of a drop).

Rows are written in parallel into one folder per landing object,
``<root>/landing=<name>/part-*``, where ``name`` comes from a column (e.g.
``events_20240101.jsonl``). Readers in :mod:`tierflow.sources.landing` treat
such a folder exactly like a single delivered file of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.sources.landing import PARTITION_COL


def write_landing(df: DataFrame, root: str, name: Column | str, fmt: str, *, mode: str = "append",
                  compression: str | None = None, rows_per_file: int | None = None, level: str | None = None) -> str:
    """``fmt``: ``csv`` (with header), ``ndjson`` or ``json`` (one object per
    part file line). No shuffle: every task writes its own part file into
    each object folder it has rows for, so a hot object is still written by
    many tasks in parallel. ``compression`` names a codec that Spark reads by the
    part's suffix (``snappy``, ``gzip``); such a part is read by one task, so
    ``rows_per_file`` then bounds what a part holds; ``level`` is that of gzip, as
    Hadoop names it (``BEST_SPEED``, ``TWO`` ...)."""
    name_col = F.col(name) if isinstance(name, str) else name
    out = df.withColumn(PARTITION_COL, name_col)
    w = (out.write.mode(mode).partitionBy(PARTITION_COL)
         .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
         .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))
    if compression:
        w = w.option("compression", compression)
    if level:
        w = w.option("zlib.compress.level", level)
    if rows_per_file:
        w = w.option("maxRecordsPerFile", rows_per_file)
    if fmt == "csv":
        w.option("header", True).option("quote", '"').option("escape", '"').csv(root)
    elif fmt in ("ndjson", "json"):
        w.json(root)
    else:
        raise ValueError(f"cannot write landing objects as {fmt}")
    return root
