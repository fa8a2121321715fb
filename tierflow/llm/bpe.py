"""Byte-level BPE encoding and decoding with a transducer lexicon.

The words of all documents are counted, the frequent ones are compiled with
their ids into a minimal acyclic transducer (``transducer.py``), executors map
its file into memory, and every distinct word of a batch is looked up there;
words that it lacks are merged exactly. What the lexicon holds changes no id,
only how many words are merged.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.runtime import in_shared, pieces, written
from tierflow.llm.tokens import _byte_letters, open_folder
from tierflow.llm.transducer import Transducer, compile_words, spread

#: Words of the lexicon at most, and their longest spelling in bytes: what is
#: collected and shipped is bounded by both.
LEXICON_WORDS, WORD_BYTES = 65_536, 32
#: Distinct words that one task counts before it hands its counts on.
COUNTED_WORDS = 200_000

_LOADED: dict[tuple, object] = {}


def _ranges(pattern: str) -> str:
    """The characters of a class of the tokenizers library, as ranges of a
    character set (its Unicode tables are not Python's)."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    points = [*range(0xD800), *range(0xE000, 0x110000)]
    found = Split(Regex(pattern), "removed", invert=True).pre_tokenize_str("".join(map(chr, points)))
    out = []
    for _, (a, z) in found:
        a, z = points[a], points[z - 1]
        if a < 0xD800 < z:
            out += [(a, 0xD7FF), (0xE000, z)]
        else:
            out.append((a, z))
    return "".join(f"\\U{a:08x}-\\U{z:08x}" for a, z in out)


def word_pattern() -> str:
    """The pre-tokenizer of byte-level vocabularies, for Python's ``re``."""
    if "words" not in _LOADED:
        letter, number, space = (_ranges(c) for c in (r"\p{L}+", r"\p{N}+", r"\s+"))
        # fixed value: the word pattern of this tokenizer format
        _LOADED["words"] = (f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
                            f"|[{space}]+(?![^{space}])|[{space}]+")
    return _LOADED["words"]


class ByteBPE:
    """One tokenizer file: words of texts, and ids of words.

    ``specials``: strings of special tokens in a text become their ids (as the
    library does by default); else they are plain text.
    """

    def __init__(self, path: str, pattern: str, lexicon: str | None = None, specials: bool = True):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = spec["added_tokens"]
        if (spec["normalizer"] or spec["pre_tokenizer"].get("type") != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]
                or not spec["pre_tokenizer"]["use_regex"] or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)):
            raise ValueError(f"{path}: not a plain byte-level tokenizer")
        self.model = Tokenizer.from_file(path).model
        self.letters = _byte_letters()
        self.space = chr(self.letters[32])
        self.find = re.compile(pattern).findall
        self.lexicon = Transducer.open(SparkFiles.get(lexicon)) if lexicon else None
        self.special = {t["content"]: t["id"] for t in added} if specials else {}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")").split if self.special else None
        spelt = {**{i: t for t, i in spec["model"]["vocab"].items()}, **{t["id"]: t["content"] for t in added}}
        back = {chr(b if b not in self.letters else self.letters[b]): b for b in range(256)}
        self.spelling = [b""] * (max(spelt) + 1)
        for i, t in spelt.items():  # a character that spells no byte makes the token plain text
            self.spelling[i] = bytes(back[c] for c in t) if all(c in back for c in t) else t.encode()
        self.bytes = Spelling(self.spelling)

    @classmethod
    def of(cls, *args) -> "ByteBPE":
        if args not in _LOADED:
            _LOADED[args] = cls(*args)
        return _LOADED[args]

    def words(self, text: str) -> list[str]:
        if self.cut and any(s in text for s in self.special):
            return [w for part in self.cut(text) if part for w in ([part] if part in self.special else self.find(part))]
        return self.find(text)

    def merged(self, word: str) -> list[int]:
        """Ids of one word by its merges."""
        if word in self.special:
            return [self.special[word]]
        spelt = word.replace(" ", self.space) if word.isascii() and word.isprintable() else \
            word.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(spelt)]

    def ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and the ids one word after another."""
        if self.lexicon is None:
            there, count, known = np.zeros(len(words), bool), np.zeros(len(words), np.int64), np.zeros(0, np.int64)
        else:
            there, count, known = self.lexicon.find([w.encode() for w in words])
        other = np.flatnonzero(~there)
        made = [self.merged(words[i]) for i in other.tolist()]
        count[other] = np.fromiter(map(len, made), np.int64, len(made))
        start = np.cumsum(count) - count
        ids = np.empty(int(count.sum()), np.int64)
        ids[spread(start[there], count[there])] = known
        ids[spread(start[other], count[other])] = np.fromiter(chain.from_iterable(made), np.int64)
        return count, ids

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text begins (one
        entry more than texts)."""
        return gather([self.words(t) for t in texts], self.ids_of)

    def decode(self, texts: list[np.ndarray]) -> list[str]:
        """Texts of ids; ids that the file lacks are passed over, and bytes that
        are no text become U+FFFD, as the library has it."""
        ids = np.concatenate([np.zeros(0, np.int64), *texts])
        known = (ids >= 0) & (ids < len(self.spelling))
        raw, edge = self.bytes.join(np.where(known, ids, 0), known)
        cut = edge[np.cumsum([0, *map(len, texts)])].tolist()
        return [raw[a:z].decode("utf-8", "replace") for a, z in zip(cut, cut[1:])]


class Spelling:
    """The bytes of every id."""

    def __init__(self, spelling: list[bytes]):
        self.size = np.fromiter(map(len, spelling), np.int64, len(spelling))
        self.start = np.cumsum(self.size) - self.size
        self.all = np.frombuffer(b"".join(spelling), np.uint8)

    def join(self, ids: np.ndarray, use: np.ndarray | bool = True) -> tuple[bytes, np.ndarray]:
        """The bytes of ids one after another, and where each begins (one entry
        more than ids); ids not in ``use`` have none."""
        size = self.size[ids] * use
        return self.all[spread(self.start[ids], size)].tobytes(), np.concatenate([[0], np.cumsum(size)])


def gather(words: list[list[str]], ids_of) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts given as words: ``ids_of`` is asked once for all distinct
    words and answers with how many ids each has, and the ids."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    words = list(chain.from_iterable(words))
    distinct = list(set(words))
    number = dict(zip(distinct, range(len(distinct))))
    at = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    count, ids = ids_of(distinct)
    start = np.cumsum(count) - count
    of_word = count[at]
    edge = np.concatenate([[0], np.cumsum(of_word)])[np.concatenate([[0], np.cumsum(sizes)])]
    return ids[spread(start[at], of_word)], edge


def _word_counter(path: str, pattern: str, specials: bool, before: str):
    def run(batches):
        enc, counts = ByteBPE.of(path, pattern, None, specials), Counter()

        def out():
            some = [w for w in counts if len(w) <= WORD_BYTES and w not in enc.special]
            return pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([counts[w] for w in some], pa.int64())],
                                              names=["word", "n"])
        for b in batches:
            for t in b.column(0).to_pylist():
                if t:
                    counts.update(enc.words(before + t))
            if len(counts) > COUNTED_WORDS:
                yield out()
                counts.clear()
        if counts:
            yield out()
    return run


def build_lexicon(docs: DataFrame, path: str, text_col: str = "text", specials: bool = True, before: str = "",
                  words: int = LEXICON_WORDS) -> str:
    """Compile the frequent words of all texts; returns the name of the shipped
    file. ``before`` is put before every text.

    At most ``words`` words are taken, by whole steps of frequency (an eighth of
    a power of two), so the choice doesn't depend on the order of rows. An empty
    table gives an empty lexicon.
    """
    spark, pattern = docs.sparkSession, word_pattern()
    made = docs.select(F.col(text_col).alias("text")).mapInArrow(_word_counter(path, pattern, specials, before), "word string, n bigint")
    counts = written(made.groupBy("word").agg(F.sum("n").alias("n")).filter(F.octet_length("word") <= WORD_BYTES)
                     .withColumn("step", F.floor(F.log2("n") * 8).cast("int")), "words")
    least, total = 1 << 30, 0
    for r in counts.groupBy("step").count().orderBy(F.desc("step")).collect():  # 8 x 63 rows at most
        total += r["count"]
        if total > words:
            break
        least = r["step"]
    enc = ByteBPE.of(path, pattern, None, specials)
    chosen = [r["word"] for r in counts.filter(F.col("step") >= least).select("word").collect()]
    flat = compile_words((w.encode(), enc.merged(w)) for w in chosen)
    name = f"lexicon-{uuid.uuid4().hex[:12]}.bin"
    folder = in_shared(spark, "lexicon")
    store, at = open_folder(folder)
    store.create_dir(at, recursive=True)
    with store.open_output_stream(f"{at}/{name}") as out:
        out.write(flat.tobytes())
    spark.sparkContext.addFile(f"{folder}/{name}")  # executors fetch it, also those that come later
    return name


def binaries(data: np.ndarray, edge: np.ndarray) -> pa.Array:
    """Rows of bytes: ``data`` cut at ``edge`` (in entries of data)."""
    return pa.Array.from_buffers(pa.large_binary(), len(edge) - 1, [
        None, pa.py_buffer((edge * data.itemsize).astype("<i8").tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.binary())


def encode_texts(docs: DataFrame, path: str, lexicon: str, id_col: str = "doc_id", text_col: str = "text", specials: bool = True) -> DataFrame:
    """``(id, ids)`` of every row: ids of the whole text as little-endian 32-bit
    integers, as the tokenizers library gives them without added special tokens.

    A null text is empty and has no ids. Ids may be null or repeated: each row
    is encoded for itself. Other columns are not read. An empty table gives an
    empty result.
    """
    pattern, kind = word_pattern(), docs.schema[id_col].dataType.simpleString()

    def run(batches):
        enc = ByteBPE.of(path, pattern, lexicon, specials)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for a, z in pieces(texts):
                ids, edge = enc.encode(texts[a:z])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, z - a), binaries(ids.astype("<u4"), edge)], names=["id", "ids"])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, ids binary")


def decode_ids(encoded: DataFrame, path: str, specials: bool = True) -> DataFrame:
    """``encoded(id, ids)`` with a column ``text``: the decoded ids (special ids
    as their strings). Null ids are empty."""
    pattern, kind = word_pattern(), encoded.schema["id"].dataType.simpleString()

    def run(batches):
        enc = ByteBPE.of(path, pattern, None, specials)
        for b in batches:
            rows = [np.frombuffer(r or b"", "<u4").astype(np.int64) for r in b.column(1).to_pylist()]
            for a, z in pieces(rows):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, z - a), b.column(1).slice(a, z - a),
                                                  pa.array(enc.decode(rows[a:z]), pa.string())], names=["id", "ids", "text"])
    return encoded.select("id", "ids").mapInArrow(run, f"id {kind}, ids binary, text string")
