"""Running vectorised Python beside Spark: shipping this package to the
executors, cutting text columns into memory-bounded pieces, and written
intermediate tables in the shared folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.session import work_dir

#: Rows of one Arrow batch. Texts may be long, so batches are kept small.
BATCH_ROWS = 512
#: Characters that one vectorised step works on (a longer text goes alone).
PIECE_CHARS = 1 << 20

_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Make this package importable on the executors and bound Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        fd, path = tempfile.mkstemp(prefix="tierflow-", suffix=".zip")
        os.close(fd)
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(os.path.join(root, "tierflow")):
                for n in sorted(names):
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.relpath(full, root))
        spark.sparkContext.addPyFile(path)
        _shipped.add(app)


def pieces(texts: list[str], limit: int = PIECE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` with at most ``limit`` characters each, or one text."""
    a = size = 0
    for i, t in enumerate(texts):
        if i > a and size + len(t) > limit:
            yield a, i
            a, size = i, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts)


def map_texts(df: DataFrame, fn: Callable, schema: str, **kw) -> DataFrame:
    """Run ``fn(texts, columns)`` over pieces of a frame that has a column
    ``text`` (null is read as empty) and any others.

    ``columns`` maps each other column to a list, in step with ``texts``. ``fn``
    returns a dict of equally long lists or arrays for ``schema``.
    """
    from pyspark.sql.types import StructType, _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    parsed = _parse_datatype_string(schema)
    assert isinstance(parsed, StructType)
    arrow = to_arrow_schema(parsed)
    others = [c for c in df.columns if c != "text"]

    def run(batches):
        for b in batches:
            texts = [t or "" for t in b.column(b.schema.get_field_index("text")).to_pylist()]
            cols = {c: b.column(b.schema.get_field_index(c)) for c in others}
            for a, z in pieces(texts):
                out = fn(texts[a:z], {c: v.slice(a, z - a) for c, v in cols.items()}, **kw)
                if out is not None:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[f.name], type=f.type) if not isinstance(out[f.name], pa.Array)
                         else out[f.name].cast(f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder and read
    back: the lineage is cut and survives lost executors."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def bucketed(df: DataFrame, name: str, buckets: int, key: str, *order: str) -> DataFrame:
    """:func:`written` by the hash of ``key``, in ``order`` within a bucket: what
    joins or groups the result by ``key`` does not shuffle it again."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    table = "tierflow_" + re.sub("[^0-9a-zA-Z]", "_", path.rsplit("/", 1)[-1]) + "_" + uuid.uuid4().hex
    df.repartition(buckets, key).write.format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key, *order).saveAsTable(table)
    return spark.table(table)


def in_shared(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return work_dir(spark, name)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have in any case."""
    have, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in have:
            n += "_"
        have.add(n.lower())
        out.append(n)
    return out


def columns_of(df: DataFrame) -> list:
    """All columns of ``df``, whatever their names hold."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


def held_out(key) -> "F.Column":
    """True for the third of the rows that no model may learn from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learnable(key) -> "F.Column":
    """True for keyed rows outside the held-out third (a null key: false)."""
    return key.isNotNull() & (F.crc32(key.cast("string").cast("binary")) % 3 != 1)
