"""Token ids as binary shards with a perfect-hash index over document keys.

A folder holds ``ids-*.bin`` (raw little-endian ids of whole documents, in
ascending key order, 16 bits wide if the vocabulary allows and else 32),
``index-*.npz`` (a ``KeyIndex`` from key to shard, offset and length) and two
Parquet tables, ``locations`` and ``shards``. Any document is read with one
index probe and one ranged read.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.perfect_hash import KeyIndex
from tierflow.llm.runtime import in_shared

#: Words whose ids one worker remembers, and as many halves of words; beyond it
#: either memory starts anew.
CACHE_WORDS = 300_000
#: Keys of one index file at most, on average.
INDEX_KEYS = 1_000_000

_LOADED: dict[str, tuple] = {}


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder, local or remote, by its address."""
    if uri.startswith("file:"):
        uri = "file:///" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


# letters whose composed and lower-case forms are single letters, then punctuation without the apostrophe
_SIMPLE = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u024F]*)([!-&(-/:-@\[-`{-~]*)")


def _byte_letters() -> dict[int, int]:
    """How a byte-level vocabulary spells bytes: printable ones as they are,
    the others, in order, as the characters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (b for b in range(256) if b not in plain)
    return {b: 256 + i for i, b in enumerate(rest)}


class Encoder:
    """Ids of whole texts by a public tokenizer file (lower-casing byte-level
    BPE that drops white space).

    A text's ids are those of its space-separated parts, one after another, and
    parts seen before are not encoded again. Nor need the whole tokenizer run
    for a part of letters and then punctuation: its pre-tokenizer cuts exactly
    there, so the BPE model gets the two halves directly.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.known: dict[str, bytes] = {}
        self.halves: dict[str, bytes] = {"": b""}

    @classmethod
    def of(cls, path: str) -> "Encoder":
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        if path not in _LOADED:
            _LOADED[path] = cls(path)
        return _LOADED[path]

    def _half(self, piece: str) -> bytes:
        got = self.halves.get(piece)
        if got is None:
            spelt = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
            got = self.halves[piece] = array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()
        return got

    def _learn(self, new: list[str]) -> None:
        odd, known, halves = [], self.known, self.halves
        for w in new:
            if w.isascii() and w.isalpha():
                low = w.lower()
                known[w] = halves.get(low) or self._half(low)
                continue
            m = _SIMPLE.fullmatch(w)
            if m:
                known[w] = self._half(m[1].lower()) + self._half(m[2])
            else:
                odd.append(w)
        for a in range(0, len(odd), 4096):
            some = odd[a:a + 4096]
            for w, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                self.known[w] = array("I", e.ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, without special ids."""
        parts = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        new = {w for p in parts for w in p} - self.known.keys()
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known, new = {}, {w for p in parts for w in p}
            if len(self.halves) > CACHE_WORDS:
                self.halves = {"": b""}
        self._learn(list(new))
        known = self.known
        return [b"".join([known[w] for w in p]) for p in parts]


def _writer(folder: str, tokenizer: str, end_id: int, width: int):
    """Streams sorted (id, key, text) rows of one task into one shard file."""
    def run(batches):
        shard, out, at, last, occ = TaskContext.get().partitionId(), None, 0, object(), 0
        name = f"ids-{shard:06d}-{uuid.uuid4().hex[:12]}.bin"  # another attempt writes another file
        enc, end = Encoder.of(tokenizer), np.array([end_id], "<u4").tobytes()
        store, path = open_folder(folder)
        try:
            for b in batches:
                keys = b.column(b.schema.get_field_index("key")).to_pylist()
                texts = [t or "" for t in b.column(b.schema.get_field_index("text")).to_pylist()]
                if not keys:
                    continue
                out = out or store.open_output_stream(f"{path}/{name}")
                offset, size, occs = [], [], []
                for key, raw in zip(keys, enc.encode(texts)):
                    ids = np.frombuffer(raw + end, "<u4")
                    out.write(ids.astype(f"<u{width}").tobytes())
                    occ = occ + 1 if key == last else 0
                    last = key
                    offset.append(at)
                    size.append(len(ids))
                    occs.append(occ)
                    at += len(ids)
                n = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [b.column(b.schema.get_field_index("id")), pa.array(keys, pa.string()), pa.array(occs, pa.int64()),
                     pa.array([shard] * n, pa.int32()), pa.array([name] * n, pa.string()),
                     pa.array(offset, pa.int64()), pa.array(size, pa.int64())],
                    names=["id", "key", "occurrence", "shard", "file", "position", "n_tokens"])
        finally:
            if out is not None:
                out.close()
    return run


def _rows_by(batches, group: str, columns: tuple[str, ...]):
    """All rows of one task, by the value of ``group`` (narrow rows only)."""
    rows: dict = {}
    for b in batches:
        at = {c: b.column(b.schema.get_field_index(c)) for c in (group, *columns)}
        g = at[group].to_numpy(zero_copy_only=False)
        for value in np.unique(g).tolist():
            pick = pa.array(np.flatnonzero(g == value))
            rows.setdefault(value, []).append([at[c].take(pick) for c in columns])
    for value, parts in rows.items():
        yield value, {c: pa.concat_arrays([p[i] for p in parts]) for i, c in enumerate(columns)}


def _index_builder(folder: str):
    def run(batches):
        store, path = open_folder(folder)
        for value, c in _rows_by(batches, "part", ("key", "shard", "position", "n_tokens")):
            index = KeyIndex.build(c["key"].to_pylist(), {k: c[k].to_numpy() for k in ("shard", "position", "n_tokens")})
            name = f"index-{value:06d}-{uuid.uuid4().hex[:12]}.npz"
            with store.open_output_stream(f"{path}/{name}") as out:
                out.write(index.to_bytes())
            yield pa.RecordBatch.from_arrays([pa.array([value], pa.int32()), pa.array([name], pa.string()),
                                              pa.array([len(c["key"])], pa.int64())], names=["part", "file", "n_keys"])
    return run


@dataclass
class TokenStore:
    """A written folder: ``shards`` is one row per payload file, in order, and
    ``indexes`` the index file of each part (both bounded by the file counts)."""

    spark: SparkSession
    folder: str
    width: int
    parts: int
    shards: list
    indexes: dict[int, str]

    def keys(self) -> DataFrame:
        """Every written document: its id and its index key."""
        return self.spark.read.parquet(f"{self.folder}/locations").select("id", "key", "part")

    def locate(self, keys: DataFrame) -> DataFrame:
        """``keys(id, key, part)`` -> the same with shard, position, n_tokens
        from the index; a key that is not there gives no row."""
        folder, files = self.folder, self.indexes
        kind = keys.schema["id"].dataType.simpleString()

        def run(batches):
            store, path = open_folder(folder)
            for value, c in _rows_by(batches, "part", ("id", "key")):
                if value not in files:
                    continue
                with store.open_input_file(f"{path}/{files[value]}") as f:
                    index = KeyIndex.from_bytes(f.read())
                there, found = index.find(c["key"].to_pylist())
                pick = pa.array(np.flatnonzero(there))
                yield pa.RecordBatch.from_arrays(
                    [c["id"].take(pick), c["key"].take(pick), *[
                        pa.array(found[k][there], t) for k, t in
                        (("shard", pa.int32()), ("position", pa.int64()), ("n_tokens", pa.int64()))]],
                    names=["id", "key", "shard", "position", "n_tokens"])
        return keys.repartition(self.parts, "part").mapInArrow(
            run, f"id {kind}, key string, shard int, position bigint, n_tokens bigint")

    def read(self, located: DataFrame, digest: bool = False) -> DataFrame:
        """Ids of located documents from the payload files: ``(id, key, start,
        n_tokens, ids)``, or with ``digest`` ``ids_crc32`` in place of ids.
        ``start`` counts the ids of all documents before."""
        folder, width = self.folder, self.width
        files = {s["shard"]: (s["file"], s["start"]) for s in self.shards}
        kind = located.schema["id"].dataType.simpleString()
        last = ("ids_crc32", pa.int64(), "bigint") if digest else ("ids", pa.list_(pa.int64()), "array<bigint>")

        def run(batches):
            store, path = open_folder(folder)
            opened, f = None, None
            for b in batches:
                col = {c: b.column(b.schema.get_field_index(c)) for c in b.schema.names}
                starts, values = [], []
                for shard, at, n in zip(col["shard"].to_pylist(), col["position"].to_pylist(), col["n_tokens"].to_pylist()):
                    if shard != opened:  # rows come sorted by shard
                        if f is not None:
                            f.close()
                        opened, f = shard, store.open_input_file(f"{path}/{files[shard][0]}")
                    f.seek(at * width)
                    ids = np.frombuffer(f.read(n * width), f"<u{width}").astype("<u4")
                    starts.append(files[shard][1] + at)
                    values.append(zlib.crc32(ids.tobytes()) if digest else ids.astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [col["id"], col["key"], pa.array(starts, pa.int64()), col["n_tokens"], pa.array(values, last[1])],
                    names=["id", "key", "start", "n_tokens", last[0]])
            if f is not None:
                f.close()
        return located.repartition("shard").sortWithinPartitions("shard", "position").mapInArrow(
            run, f"id {kind}, key string, start bigint, n_tokens bigint, {last[0]} {last[2]}")


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                 folder: str | None = None, vocabulary: int = 49_408) -> TokenStore:
    """Encode every whole text with the tokenizer file ``tokenizer``, append
    ``end_id``, and write shards and index below ``folder`` (a new one in the
    shared folder if none is named; it must be one that all executors reach).

    Documents are written in ascending id order, nulls first, ties by a hash of
    the text. The key of a document is its id as text (``null`` for a null id,
    which has a key of its own kind); the second, third ... row of one id has
    ``#1``, ``#2`` ... behind a zero character, in file order. A null text is
    empty and has the end id only. An empty table gives an empty folder.
    ``vocabulary``: ids are below it; under 65,536 they take 16 bits.
    """
    spark = docs.sparkSession
    folder = folder or in_shared(spark, "tokens")
    store, path = open_folder(folder)
    store.create_dir(path, recursive=True)
    width = 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.withColumns({"tie": F.xxhash64("text"), "key": F.when(F.col("id").isNull(), F.lit("\0null"))
                             .otherwise(F.col("id").cast("string"))})
    kind = docs.schema[id_col].dataType.simpleString()
    ordered = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "key", "text")
    ordered.mapInArrow(_writer(folder, tokenizer, end_id, width),
                       f"id {kind}, key string, occurrence bigint, shard int, file string, position bigint, n_tokens bigint"
                       ).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")

    # one row per shard, in order: where it starts, and how often its first key was written before
    shards, start, carried = [], 0, {}
    for s in rows.groupBy("shard", "file").agg(
            F.sum("n_tokens").alias("n_ids"), F.count("*").alias("n_docs"), F.min_by("key", "position").alias("first"),
            F.max_by("key", "position").alias("last"), F.max_by("occurrence", "position").alias("occurrence"),
            ).orderBy("shard").collect():
        before = carried.get(s["first"], 0)
        shards.append({**s.asDict(), "start": start, "before": before})
        start += s["n_ids"]
        carried = {s["last"]: s["occurrence"] + 1 + (before if s["first"] == s["last"] else 0)}
    n_docs = sum(s["n_docs"] for s in shards)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_docs // INDEX_KEYS))

    split = [(s["shard"], s["first"], s["before"]) for s in shards if s["before"]]
    if split:  # an id whose rows fill more than one shard
        rows = rows.join(spark.createDataFrame(split, "shard int, key string, before bigint"), ["shard", "key"], "left")
        rows = rows.withColumn("occurrence", F.col("occurrence") + F.coalesce("before", F.lit(0)))
    again = F.concat("key", F.lit("\0#"), F.col("occurrence").cast("string"))
    rows = rows.withColumn("key", F.when(F.col("occurrence") == 0, F.col("key")).otherwise(again))
    rows.select("id", "key", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int").alias("part"), "shard", "position",
                "n_tokens").write.parquet(f"{folder}/locations")
    written = spark.read.parquet(f"{folder}/locations").select("key", "part", "shard", "position", "n_tokens")
    built = written.repartition(parts, "part").mapInArrow(_index_builder(folder), "part int, file string, n_keys bigint")
    built.write.parquet(f"{folder}/indexes")
    indexes = {r["part"]: r["file"] for r in spark.read.parquet(f"{folder}/indexes").collect()}
    if shards:
        spark.createDataFrame([(s["shard"], s["file"], s["start"], s["n_ids"], s["n_docs"], width) for s in shards],
                              "shard int, file string, start bigint, n_ids bigint, n_docs bigint, width int"
                              ).coalesce(1).write.parquet(f"{folder}/shards")
    return TokenStore(spark, folder, width, parts, shards, indexes)
