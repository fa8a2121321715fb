"""Structured Streaming ingestion: incremental bronze and silver upserts.

* :func:`stream_bronze` — file source with the contract as an all-string
  schema (no inference), lineage columns, Parquet sink with a checkpoint,
  ``availableNow`` trigger: each run picks up only files not yet committed,
  so a restart adds nothing.
* :func:`stream_upsert` — ``foreachBatch``: per micro-batch keep the latest
  row per key, then upsert it into the silver snapshot table. The upsert is
  idempotent, so a replayed batch after a failure is harmless; the batch id
  is recorded in the sink's commit log by Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierflow.operators.dedupe import latest_per_key
from tierflow.sinks.store import TableStore
from tierflow.sources.contracts import inspect_ndjson
from tierflow.sources.contracts import rescue as rescue_columns
from tierflow.sources.landing import PARTITION_COL, csv_options, file_name_col


def contract_schema(contract: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in contract])


def read_stream(spark: SparkSession, landing_dir: str, contract: Sequence[str], fmt: str = "ndjson",
                *, max_files_per_trigger: int | None = None, rescue: Sequence[str] | None = None) -> DataFrame:
    """The contract's columns as delivered text, and ``_source_file``.

    CSV files must have the contract's columns as their header, in its order
    (names are compared, so a file with others fails the stream instead of
    landing in the wrong columns). NDJSON fields bind by name; ``rescue`` names
    fields beyond the contract that are kept, as delivered text, in the JSON
    object ``_rescued_data``. Malformed records fail the stream."""
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    cols = [F.col(c) for c in contract]
    if fmt == "csv":
        if rescue is not None:
            raise ValueError("a CSV stream has no columns to rescue: its header must be the contract")
        r = csv_options(r.schema(contract_schema(contract)).option("enforceSchema", False))
        return r.csv(landing_dir).select(*cols, file_name_col().alias("_source_file"))
    names = [*contract, *(n for n in rescue or () if n not in contract)]
    df = r.schema(contract_schema(names)).option("mode", "FAILFAST").json(landing_dir)
    if rescue is None:
        return df.select(*cols, file_name_col().alias("_source_file"))
    return rescue_columns(df.select(*[F.col(f"`{n}`") for n in names], file_name_col().alias("_source_file")), contract,
                          keep=("_source_file",))


def unexpected_fields(spark: SparkSession, landing_dir: str, contract: Sequence[str]) -> dict[str, set[str]]:
    """Landing objects with fields beyond the contract, and those fields."""
    seen = inspect_ndjson(spark, landing_dir, contract).where(F.size("unexpected") > 0)
    return {r["file"]: set(r["unexpected"]) for r in seen.select("file", "unexpected").collect()}


def stream_bronze(spark: SparkSession, landing_dir: str, bronze_path: str, checkpoint: str,
                  contract: Sequence[str], run_id: str, fmt: str = "ndjson", *, rescue: bool = False) -> int:
    """Run the incremental bronze load to completion; returns the rows that are
    in bronze from this run (0 when there was nothing new).

    With ``rescue`` (NDJSON) the fields beyond the contract are listed first.
    Bronze keeps every delivered row, late and repeated ones too: duplicates
    are settled in silver, where the latest row of a key wins."""
    extra = unexpected_fields(spark, landing_dir, contract) if rescue else {}
    known = set().union(*extra.values())
    df = read_stream(spark, landing_dir, contract, fmt, rescue=sorted(known) if rescue else None)
    df = df.withColumns({"_ingested_at": F.localtimestamp(), "_run_id": F.lit(run_id)})
    q = (df.writeStream.format("parquet").option("path", bronze_path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    mine = spark.read.schema(df.schema).parquet(bronze_path).where(F.col("_run_id") == run_id)
    if rescue:  # a file that came after the fields were listed may have brought others
        late = {f: sorted(n - known) for f, n in unexpected_fields(spark, landing_dir, contract).items() if n - known}
        if late and mine.where(F.col("_source_file").isin(list(late))).limit(1).count():
            raise RuntimeError(f"fields that this run could not rescue: {late}; ingest these objects again")
    return mine.count()


def stream_to_store(store: TableStore, source: str, landing_dir: str, checkpoint: str, contract: Sequence[str],
                    run_id: str, fmt: str = "ndjson", *, rescue: bool = False) -> int:
    """:func:`stream_bronze` into ``bronze.<source>``, where the daily job and
    ``store.read`` find it."""
    return stream_bronze(store.spark, landing_dir, store.stream_target("bronze", source), checkpoint, contract, run_id,
                         fmt, rescue=rescue)


def stream_upsert(spark: SparkSession, landing_dir: str, store: TableStore, table: str,
                  checkpoint: str, contract: Sequence[str], key: Sequence[str],
                  transform=None, fmt: str = "ndjson", max_files_per_trigger: int | None = 256,
                  partition_by: str | None = None) -> int:
    """Micro-batches: latest row per key (by ingest time, then source file),
    optional typing ``transform``, then upsert into ``silver.<table>``
    (partition-scoped when ``partition_by`` is given, so a micro-batch only
    rewrites the partitions it touches). Snapshots that no reader needs any
    more are removed after each batch. Returns the rows of the table."""
    src = read_stream(spark, landing_dir, contract, fmt, max_files_per_trigger=max_files_per_trigger)
    src = src.withColumn("_ingested_at", F.localtimestamp())

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        latest = latest_per_key(batch, list(key), ["_ingested_at", "_source_file",
                                                   *[c for c in contract if c not in key]])
        out = transform(latest) if transform else latest
        out = out.withColumn("_batch_id", F.lit(batch_id).cast("long"))
        store.merge("silver", table, out, key=list(key), partition_by=partition_by)
        store.vacuum("silver", table, keep=2)

    q = (src.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return store.read("silver", table).count() if store.exists("silver", table) else 0


__all__ = ["contract_schema", "read_stream", "stream_bronze", "stream_to_store", "stream_upsert", "PARTITION_COL"]
