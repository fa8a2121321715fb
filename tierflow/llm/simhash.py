"""SimHash near-duplicates found by deletion-variant signatures.

A 64-bit fingerprint is cut into three segments (22, 21, 21 bits). Of two
fingerprints at most four bits apart, one segment differs in at most one bit
(two or more in each would be six). So every fingerprint is indexed under each
segment with one bit wildcarded: 64 keys (segment, wildcard, other bits). Two
fingerprints that share a key are compared in full, inside an equality join.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tierflow.llm.components import connected_components
from tierflow.llm.runtime import fresh, map_texts, written

_SEGMENTS = ((0, 22), (22, 21), (43, 21))
MAX_BITS = 4
_WORD = re.compile(rb"[^ \t-\r]+")


def fingerprint(text: str, shingle: int = 4, seed: int = 42) -> int:
    """Signed 64-bit SimHash of a whole text; no words: zero.

    Words are runs of anything but space and U+0009 to U+000D, A-Z lower-cased.
    A bit is set where more than half of the shingle hashes have it, repeats
    included; a text of fewer words has one shingle, the whole sequence.
    """
    words = _WORD.findall(text.encode("utf-8", "surrogatepass").lower())  # bytes.lower: A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    n = max(1, len(words) - shingle + 1)
    begin, stop = (end - size)[:n].tolist(), end[len(words) - n:].tolist()
    h = np.array([xxh64_intdigest(joined[a:z], seed) for a, z in zip(begin, stop)], dtype="<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def _fingerprints(texts, cols, shingle, seed):
    return {"id": cols["id"], "tie": cols["tie"], "fp": [fingerprint(t, shingle, seed) for t in texts]}


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 4, seed: int = 42) -> DataFrame:
    """``(id, tie, fp bigint)`` per row; a null text counts as empty. ``tie`` is
    a hash of the text as it is, to tell rows of one id apart."""
    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("tie"), F.col(text_col).alias("text")),
                     _fingerprints, f"id {kind}, tie bigint, fp bigint", shingle=shingle, seed=seed)


def _segment(x, segment: int) -> "F.Column":
    at, size = _SEGMENTS[segment]
    return F.shiftrightunsigned(x, at).bitwiseAND(F.lit((1 << size) - 1).cast("bigint"))


def signatures(fps: DataFrame) -> DataFrame:
    """``fp`` -> 64 rows ``(slot, key, fp)``: slot names the wildcarded bit (and
    so the segment), key holds the segment's other bits."""
    def variants(segment: int):
        at, size = _SEGMENTS[segment]
        part = _segment("fp", segment).cast("int")
        return [F.struct(F.lit(at + p).cast("byte").alias("slot"),
                         part.bitwiseAND(F.lit(((1 << size) - 1) & ~(1 << p))).alias("key")) for p in range(size)]
    keys = [v for s in range(len(_SEGMENTS)) for v in variants(s)]
    return fps.select("fp", F.explode(F.array(*keys)).alias("s")).select("s.slot", "s.key", "fp")


def _first_slot(x) -> "F.Column":
    """The first slot under which two fingerprints with difference ``x`` meet:
    so each link comes out of one key only."""
    out = F.lit(None).cast("int")
    for s in reversed(range(len(_SEGMENTS))):
        part = _segment(x, s)
        # one differing bit: its own slot (the ones below it are counted); none: the segment's first
        here = F.lit(_SEGMENTS[s][0]) + F.when(part == 0, F.lit(0)).otherwise(F.bit_count(part - 1))
        out = F.when(F.bit_count(part) <= 1, here).otherwise(out)
    return out


def near_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``(a, b)``, a < b, between the distinct fingerprints of ``fps`` that
    differ in at most ``max_bits`` (0 to 4) bits; each link once, none lost.

    The signatures are sorted and merged whatever Spark takes their size to be:
    it reckons an exploded table as large as the table before, a 64th of what
    a broadcast of it would hold."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"three segments with one wildcard find links of up to {MAX_BITS} bits, not {max_bits}")
    sig = signatures(fps)
    left = sig.select("slot", "key", F.col("fp").alias("a"))
    right = sig.select("slot", "key", F.col("fp").alias("b"))
    x = F.col("a").bitwiseXOR(F.col("b"))
    found = left.hint("merge").join(right.withColumnsRenamed({"slot": "slot2", "key": "key2"}),
                      (F.col("slot") == F.col("slot2")) & (F.col("key") == F.col("key2")) & (F.col("a") < F.col("b"))
                      & (F.bit_count(x) <= max_bits) & (F.col("slot") == _first_slot(x)))
    return found.select("a", "b")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                  max_bits: int = MAX_BITS, seed: int = 42) -> DataFrame:
    """``(id, tie, fp bigint, root, component_id, kept)`` for every row of ``docs``;
    ``root`` is the smallest fingerprint of the group.

    Rows with one fingerprint, or fingerprints at most ``max_bits`` apart, are
    linked; ``component_id`` is the smallest id that links reach and ``kept``
    says that the row has that id. Null and empty texts have fingerprint zero
    and are linked like others. Rows with a null id take the component of their
    fingerprint (null if no row there has an id) and are not kept. Repeated rows
    come out as often as they came in. An empty table gives an empty result.
    """
    marked = written(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    # copies collapse before any search: one row per distinct fingerprint
    distinct = written(marked.groupBy("fp").agg(F.min("id").alias("low")), "distinct")
    roots = written(connected_components(near_links(distinct.select("fp"), max_bits)), "roots")
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "low")
    lows = written(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "lows")
    classes = written(written(rooted, "rooted").join(lows, "root").select("fp", "root", "component_id"), "classes")
    return marked.join(classes, "fp").select(
        "id", "tie", "fp", "root", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, of which each group of
    near-duplicates keeps one: a row with the group's smallest id (of several,
    the one whose text hashes lowest; of rows alike in both, any). Rows with a
    null id cannot stand for a group and are all kept. ``options`` go to
    ``simhash_dedup``."""
    tie, kept_id, kept_tie = fresh(docs, "__tie", "__kept_id", "__kept_tie")
    keep = simhash_dedup(docs, id_col, text_col, **options).filter("kept").groupBy("root", "id").agg(F.min("tie").alias("tie"))
    keep = written(keep.select(F.col("id").alias(kept_id), F.col("tie").alias(kept_tie)), "keep")
    marked = docs.withColumn(tie, F.xxhash64(F.col(text_col)))
    same = (F.col(id_col) == F.col(kept_id)) & (F.col(tie) == F.col(kept_tie))
    # merged, not broadcast: a tenth of the table's size in memory is what its file has
    kept = marked.join(keep.hint("merge"), same, "left_semi").dropDuplicates([id_col, tie]).drop(tie)
    return kept.unionByName(docs.filter(F.col(id_col).isNull()))
