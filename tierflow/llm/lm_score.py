"""Cross-entropy difference with matched bigram models.

Both models share one vocabulary (every word of either, or the most frequent
words of the corpus if a size is given; all others are one unknown word), order
and smoothing: a bigram estimate backed off to the unigram one,
p(w|h) = (c(h,w) + K p(w)) / (c(h) + K) with p(w) = (c(w) + 1) / (N + V). The
target model counts target documents, the background model as much text of
other documents: the larger side is sampled, document by document, by a seeded
hash. A document that a model counts is taken out of it (its own counts are
subtracted) when it is scored, so a score tells how close a text is to the
target, not whether it is part of it. The score is the mean over a document's
words of target loss minus background loss: lower is closer to the target.

Counts cover every word and every bigram of the counted documents, each under a
hash that is twenty bits wider than the corpus has characters (63 bits at most),
in a table that grows with them and is never held in one place: it is cut into
ranges of the hash, more of them the more text there is. Texts are scored a
piece at a time: a piece asks every range for the counts of its distinct words
and bigrams, so a hot word is asked for once a piece; the answer is counts alone,
in the order of the keys, which the piece works out again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.runtime import bucketed, pieces, written
from tierflow.llm.words import Piece, mix

PRIOR = 5.0
#: Characters of text for each range of the count table, and for each piece.
RANGE_CHARS, SCORED_CHARS = 1 << 25, 1 << 22
#: Files of dealt texts at most: Spark's own bound on buckets.
MOST_BUCKETS = 100_000
_FLUSH = 1 << 20
#: Stand for the unknown word and the beginning of a text.
_UNKNOWN, _BEGIN = np.uint64(0), np.uint64(1)
_COUNTS = "range int, n int, keys binary, target binary, background binary"
#: Documents are sampled by buckets of a hash.
SEED, BUCKETS = 11, 4096
#: What a document is for the models.
_NEITHER, _TARGET, _BACKGROUND = 0, 1, 2


def _batches(batches, *columns: str) -> Iterator[tuple]:
    for b in batches:
        texts = [t or "" for t in b.column(b.schema.get_field_index("text")).to_pylist()]
        more = [b.column(b.schema.get_field_index(c)) for c in columns]
        for a, z in pieces(texts):
            yield (texts[a:z], *[m.slice(a, z - a) for m in more])


def _merged(parts: list) -> tuple[np.ndarray, ...]:
    """Parts of (keys, counts, ...), summed by key."""
    h = np.concatenate([p[0] for p in parts])
    order = np.argsort(h)
    h = h[order]
    at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return h[at], *(np.add.reduceat(np.concatenate([p[k] for p in parts])[order], at) if len(h) else np.zeros(0, np.int64)
                    for k in range(1, len(parts[0])))


def _count_words(batches):
    parts: list = []
    held = 0

    def rows():
        h, n = _merged(parts)
        for a in range(0, len(h), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(h[a:a + (1 << 16)].view(np.int64)), pa.array(n[a:a + (1 << 16)])], names=["word", "n"])
    for (texts,) in _batches(batches):
        h, n = np.unique(Piece(texts).hashes(), return_counts=True)
        parts.append((h, n))
        held += len(h)
        if held > _FLUSH:
            parts = [_merged(parts)]
            held = len(parts[0][0])
            if held > _FLUSH // 2:
                yield from rows()
                parts, held = [], 0
    if parts:
        yield from rows()


def vocabulary(docs: DataFrame, size: int) -> np.ndarray:
    """Sorted hashes of the most frequent words of ``docs(text)``, ``size`` at
    most: all whose count is on or above the lowest step (of a sixteenth of a
    power of two) that leaves so few."""
    words = written(docs.select("text").mapInArrow(_count_words, "word bigint, n bigint").groupBy("word").agg(
        F.sum("n").alias("n")), "words")
    step = F.floor(F.log2(F.col("n").cast("double")) * 16)
    steps = sorted(((r["step"], r["words"]) for r in words.groupBy(step.alias("step")).agg(
        F.count("*").alias("words")).collect()), reverse=True)  # a thousand rows at most
    least, total = None, 0
    for s, n in steps:
        total += n
        if total > size:
            break
        least = s
    if least is None:
        return np.zeros(0, np.uint64)
    got = words.filter(step >= least).select("word").collect()
    return np.sort(np.array([r["word"] for r in got], np.int64).view(np.uint64))


def _narrow(a: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs, byte by byte of
    all, so that bytes that are mostly zero compress."""
    width = max(1, -(-int(a.max()).bit_length() // 8)) if len(a) else 0
    return a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    if n:
        out[:, :len(data) // n] = np.frombuffer(data, np.uint8).reshape(-1, n).T
    return out.reshape(-1).view("<u8")


@dataclass
class _Words:
    """Keys of the counts: an odd key is a word's, an even one that of a bigram
    or of a word as history. ``known``: sorted hashes of the vocabulary, or None
    for every word. ``width``: bits of a key; its first ``bits`` are its range."""

    known: np.ndarray | None
    bits: int
    width: int

    def keys(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text index, and keys of bigram, word and history, of all words of
        whole texts."""
        p = Piece(texts)
        word = p.hashes()
        if self.known is not None:
            at = np.searchsorted(self.known, word)
            word = np.where(np.append(self.known, _UNKNOWN)[at] == word, word, _UNKNOWN)
        before = np.concatenate([[_BEGIN], word[:-1]]) if len(word) else word
        before[np.flatnonzero(np.diff(p.doc, prepend=-1))] = _BEGIN
        pair = mix(mix(before + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0x9E3779B97F4A7C15) + word)
        even, cut = ~np.uint64(1), np.uint64(64 - self.width)
        return (p.doc, pair >> cut & even, mix(word ^ np.uint64(0xD1B54A32D192ED03)) >> cut | np.uint64(1),
                mix(before ^ np.uint64(0x8CB92BA72F3D8DD7)) >> cut & even)

    def cut(self, keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Ranges that sorted keys lie in: (range, from, to)."""
        of = (keys >> np.uint64(self.width - self.bits)).astype(np.int64)
        at = np.flatnonzero(np.diff(of, prepend=-1))
        yield from zip(of[at].tolist(), at.tolist(), [*at[1:].tolist(), len(keys)])

    def pack(self, r: int, keys: np.ndarray) -> bytes:
        """Sorted keys of one range, as steps."""
        return _narrow(np.diff(keys, prepend=np.uint64(r << (self.width - self.bits))))

    def unpack(self, r: int, n: int, data: bytes) -> np.ndarray:
        return np.cumsum(_wide(data, n), dtype=np.uint64) + np.uint64(r << (self.width - self.bits))

    def batch(self, rows: list[tuple]) -> pa.RecordBatch:
        """Rows (range, keys, target, background) as ``_COUNTS``."""
        return pa.RecordBatch.from_arrays(
            [pa.array([r for r, *_ in rows], pa.int32()), pa.array([len(h) for _, h, *_ in rows], pa.int32()),
             pa.array([self.pack(r, h) for r, h, *_ in rows], pa.binary()),
             *(pa.array([_narrow(x[k]) for x in rows], pa.binary()) for k in (2, 3))],
            names=["range", "n", "keys", "target", "background"])


def _columns(b: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in names))


def _count_keys(words: _Words):
    """Rows (text, side) of counted documents -> what one task counts, by range."""
    def run(batches):
        parts: list = []
        held = 0

        def rows():
            h, target, background = _merged(parts)
            cuts = list(words.cut(h))
            for a in range(0, len(cuts), 64):
                yield words.batch([(r, h[i:j], target[i:j], background[i:j]) for r, i, j in cuts[a:a + 64]])
        for texts, side in _batches(batches, "side"):
            doc, *keys = words.keys(texts)
            side = np.array(side.to_pylist(), np.int64)[doc]
            own = [(side == k).astype(np.int64) for k in (_TARGET, _BACKGROUND)]
            parts.append(_merged([(k, *own) for k in keys]))
            held += len(parts[-1][0])
            if held > 4 * _FLUSH:
                parts = [_merged(parts)]
                held = len(parts[0][0])
                if held > 2 * _FLUSH:
                    yield from rows()
                    parts, held = [], 0
        if parts:
            yield from rows()
    return run


def _sum_keys(words: _Words):
    """Rows of ``_COUNTS`` of whole ranges -> one row for each range."""
    def run(batches):
        parts: dict[int, list] = {}
        held: dict[int, int] = {}
        for b in batches:
            for r, n, keys, target, background in _columns(b, "range", "n", "keys", "target", "background"):
                parts.setdefault(r, []).append((words.unpack(r, n, keys), *(_wide(c, n).astype(np.int64) for c in (target, background))))
                held[r] = held.get(r, 0) + n
                if held[r] > 2 * len(parts[r][0][0]) + _FLUSH:
                    parts[r] = [_merged(parts[r])]
                    held[r] = len(parts[r][0][0])
        for r in list(parts):
            h, target, background = _merged(parts.pop(r))
            odd = (h & np.uint64(1)).astype(bool)
            out = words.batch([(r, h, target, background)])
            for k, v in (("words", odd.sum()), ("n_target", target[odd].sum()), ("n_background", background[odd].sum())):
                out = out.append_column(k, pa.array([int(v)], pa.int64()))
            yield out
    return run


@dataclass
class BigramPair:
    """Both models' counts: ``counts`` holds a row for each range of the keys.
    ``marks`` has the target ids, ``buckets`` the sampled part of the target and
    of the other documents. ``size``: words of the vocabulary; ``sizes``: words
    that each model counts."""

    words: _Words
    counts: DataFrame
    marks: DataFrame
    buckets: tuple[frozenset, frozenset]
    size: int
    sizes: tuple[int, int]
    prior: float


def bucket(id_col: str = "id", text_col: str = "text") -> "F.Column":
    """The part of the corpus, from 0 to ``BUCKETS`` - 1, that a row is in."""
    return F.pmod(F.xxhash64(F.lit(SEED), F.col(id_col), F.col(text_col)), F.lit(BUCKETS)).cast("int")


def matched(chars: dict[tuple[bool, int], int]) -> tuple[frozenset, frozenset]:
    """Buckets of target and of other documents to count, from the characters of
    each (target, bucket): all of the smaller side, and of the larger one as
    many, in order, as first have as much text."""
    sides = [[chars.get((t, b), 0) for b in range(BUCKETS)] for t in (True, False)]
    least, out = min(map(sum, sides)), []
    for side in sides:
        total, n = 0, 0
        while n < BUCKETS and total < least:
            total, n = total + side[n], n + 1
        out.append(frozenset(range(BUCKETS if sum(side) <= least else n)))
    return out[0], out[1]


def _side(buckets: tuple[frozenset, frozenset], target) -> "F.Column":
    def inside(chosen):
        return F.lit(True) if len(chosen) == BUCKETS else F.col("bucket").isin(sorted(chosen))
    return F.when(target, F.when(inside(buckets[0]), F.lit(_TARGET)).otherwise(F.lit(_NEITHER))).otherwise(
        F.when(inside(buckets[1]), F.lit(_BACKGROUND)).otherwise(F.lit(_NEITHER)))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("bucket", bucket())


def _marked(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """``rows`` with a column ``target``; whichever way Spark joins them by size."""
    return rows.join(marks.withColumn("__target", F.lit(True)), "id", "left").withColumn("target", F.coalesce("__target", F.lit(False))).drop("__target")


def _deal(batches):
    """Rows (id, text, bucket), numbered by piece and place in it."""
    task, number, size, place = TaskContext.get().partitionId(), 0, 0, 0
    for b in batches:
        at, places = [], []
        for t in b.column(b.schema.get_field_index("text")).to_pylist():
            if size and size + len(t or "") > SCORED_CHARS:
                number, size, place = number + 1, 0, 0
            size += len(t or "") + 64  # a piece of empty texts has a bound too
            at.append(task << 32 | number), places.append(place)
            place += 1
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(places, pa.int32()), *b.columns], names=["piece", "place", *b.schema.names])


def _dealt(rows: DataFrame, marks: DataFrame, buckets: tuple[frozenset, frozenset], chars: int | None = None) -> DataFrame:
    """``(piece, place, id, text, side)``: texts dealt into pieces and written, in
    buckets of pieces, so that a piece is the same texts whenever it is read and
    no text is shuffled again. Only ids travel to the marks; what they are comes
    back for each piece. ``chars``: the text there is, if known."""
    if chars is None:
        chars = rows.agg(F.sum(F.length("text").cast("bigint"))).first()[0] or 0
    kind = rows.schema["id"].dataType.simpleString()
    dealt = rows.select("id", "text", "bucket").mapInArrow(_deal, f"piece bigint, place int, id {kind}, text string, bucket int")
    texts = bucketed(dealt, "dealt", min(MOST_BUCKETS, 1 + chars // (2 * SCORED_CHARS)), "piece", "place")
    side = _marked(texts.select("piece", "place", "id", "bucket"), marks).select("piece", "place", _side(buckets, F.col("target")).alias("side"))
    sides = written(side.groupBy("piece").agg(F.array_sort(F.collect_list(F.struct("place", "side")))["side"].alias("sides")), "sides")
    return texts.join(sides, "piece").select("piece", "place", "id", "text", F.get("sides", F.col("place")).alias("side"))


def _fit(docs: DataFrame, target: DataFrame, id_col: str, text_col: str, size: int | None, bits: int | None,
         prior: float) -> tuple[BigramPair, DataFrame]:
    rows = _rows(docs, id_col, text_col)
    kind = docs.schema[id_col].dataType
    marks = written(target.select(F.col(id_col).cast(kind).alias("id")).filter("id is not null").distinct(), "marks")
    narrow = _marked(rows.select("id", "bucket", F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("chars")), marks)
    chars = {(r["target"], r["bucket"]): r["chars"] for r in narrow.groupBy("target", "bucket").agg(
        F.sum("chars").alias("chars")).collect()}  # 2 x BUCKETS rows at most
    buckets, total = matched(chars), sum(chars.values())
    most = max(2, int(-(-total // RANGE_CHARS)).bit_length())
    words = _Words(None if size is None else vocabulary(rows, size), most if bits is None else max(1, min(bits, most)),
                   min(63, max(1, total).bit_length() + 20))
    dealt = _dealt(rows, marks, buckets, total)
    counted = dealt.filter(F.col("side") != _NEITHER).select("text", "side").mapInArrow(_count_keys(words), _COUNTS)
    counts = written(counted.repartition(1 << words.bits, "range").mapInArrow(
        _sum_keys(words), f"{_COUNTS}, words bigint, n_target bigint, n_background bigint"), "counts")
    got = counts.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("words", "n_target", "n_background"))).first()
    vocab = got["words"] if size is None else len(words.known)
    return BigramPair(words, counts, marks, buckets, vocab, (got["n_target"], got["n_background"]), prior), dealt


def fit_pair(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             size: int | None = None, bits: int | None = None, prior: float = PRIOR) -> BigramPair:
    """Count the documents of ``docs`` whose ids ``target`` lists (column
    ``id_col``), and as much text of the others. Null ids and ids that no
    document has are ignored, an id listed twice counts once, a null text is
    empty. Without target documents, or without others, both models are empty
    and every score is 0. ``size`` bounds the vocabulary (none: every word); the
    table is cut into ``2 ** bits`` ranges (none: by the text there is; never
    more than by the text, so ``bits`` changes no result)."""
    return _fit(docs, target, id_col, text_col, size, bits, prior)[0]


_ASKED = "range int, piece bigint, first int, n int, keys binary"


def _ask(words: _Words):
    """Rows (piece, place, text) -> the distinct keys of each piece, by range. A
    piece that a task reads a part of is asked for by parts; ``first`` is the
    first place of a part."""
    def run(batches):
        held: list = []
        now, first = None, 0

        def rows():
            h = _merged(held)[0]
            cuts = list(words.cut(h))
            for a in range(0, len(cuts), 64):
                part = cuts[a:a + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r for r, *_ in part], pa.int32()), pa.array([now] * len(part), pa.int64()), pa.array([first] * len(part), pa.int32()),
                     pa.array([j - i for _, i, j in part], pa.int32()),
                     pa.array([words.pack(r, h[i:j]) for r, i, j in part], pa.binary())], names=["range", "piece", "first", "n", "keys"])
        for texts, at, place in _batches(batches, "piece", "place"):
            at, place = at.to_numpy(), place.to_numpy()
            ends = [*(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
            for a, z in zip([0, *ends], ends):
                if held and at[a] != now:
                    yield from rows()
                    held = []
                if not held:
                    now, first = int(at[a]), int(place[a])
                held.append((np.unique(np.concatenate(words.keys(texts[a:z])[1:])),))
        if held:
            yield from rows()
    return run


def _answer(words: _Words):
    """Of one range, its counts and the keys that pieces ask for -> counts for
    each piece, in the order of its keys; a key that is not there counts 0."""
    def run(left, right):
        own = None
        for b in right:
            for r, n, keys, target, background in _columns(b, "range", "n", "keys", "target", "background"):
                own = words.unpack(r, n, keys), _wide(target, n), _wide(background, n)
        for b in left:
            rows = []
            for r, piece, first, n, keys in _columns(b, "range", "piece", "first", "n", "keys"):
                found = [np.zeros(n, np.uint64)] * 2
                if own is not None:
                    h = words.unpack(r, n, keys)
                    at = np.minimum(np.searchsorted(own[0], h), len(own[0]) - 1)
                    there = own[0][at] == h
                    found = [np.where(there, c[at], np.uint64(0)) for c in own[1:]]
                rows.append((r, piece, first, n, *(zlib.compress(_narrow(c), 1) for c in found)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 2))],
                    names=["range", "piece", "first", "n", "target", "background"])
    return run


_ANSWERED = "range int, piece bigint, first int, n int, target binary, background binary"


def _own(doc: np.ndarray, key: np.ndarray, of: np.ndarray) -> np.ndarray:
    """How often each word's text has its key (a small number) itself (0 where
    ``of`` is false)."""
    out = np.zeros(len(doc), np.float64)
    _, at, n = np.unique(doc[of] * (int(key.max(initial=0)) + 1) + key[of], return_inverse=True, return_counts=True)
    out[of] = n[at]
    return out


def _losses(words: _Words, size: int, sizes: tuple[int, int], prior: float):
    """Of one piece, its texts and its counts -> scores."""
    def score(texts: list[str], ids, side: np.ndarray, rows: list[tuple]):
        doc, *keys = words.keys(texts)
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)  # what was asked for, in this order
        at = at.reshape(len(keys), -1)
        n = np.bincount(doc, minlength=len(texts))
        out = []
        for k, model, total in ((2, _TARGET, sizes[0]), (3, _BACKGROUND, sizes[1])):
            c = np.concatenate([np.zeros(0, np.uint64), *(_wide(zlib.decompress(x[k]), x[1]) for x in rows)]).astype(np.float64)
            assert len(c) == len(distinct)
            mine = (side == model)[doc]
            pair, word, history = (np.maximum(c[i] - _own(doc, i, mine), 0) for i in at)
            unigram = (word + 1) / (np.maximum(total - np.where(side == model, n, 0), 0)[doc] + size + 2)
            x = -np.log((pair + prior * unigram) / (history + prior))
            out.append(np.bincount(doc, weights=x, minlength=len(texts)) / np.maximum(n, 1))
        t, e = out
        return pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(t), pa.array(e), pa.array(t - e)],
                                          names=["id", "n_words", "target_loss", "background_loss", "score"])

    def run(left, right):
        parts: dict[int, list] = {}
        for b in right:
            for r, first, *rest in _columns(b, "range", "first", "n", "target", "background"):
                parts.setdefault(first, []).append((r, *rest))
        table = pa.Table.from_batches(left)
        table = table.take(pa.array(np.argsort(table.column("place").to_numpy(), kind="stable")))
        place = table.column("place").to_numpy()
        cut = [*np.searchsorted(place, sorted({0, *parts})).tolist(), len(place)]
        for a, z in zip(cut, cut[1:]):
            if z > a:
                some = table.slice(a, z - a)
                yield score([t or "" for t in some.column("text").to_pylist()], some.column("id").combine_chunks(),
                            some.column("side").to_numpy(), sorted(parts.get(int(place[a]), []), key=lambda x: x[0]))
    return run


def _cogrouped(run, schema: str) -> tuple:
    """``run`` over the batches of two groups, for ``applyInArrow``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def tables(left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.Table.from_batches([pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(b.columns, arrow)], schema=arrow)
                                      for b in run(left.to_batches(), right.to_batches())], arrow)
    return tables, schema


def _score(dealt: DataFrame, model: BigramPair) -> DataFrame:
    kind, words = dealt.schema["id"].dataType.simpleString(), model.words
    asked = dealt.select("piece", "place", "text").mapInArrow(_ask(words), _ASKED)
    answers = asked.groupBy("range").cogroup(model.counts.groupBy("range")).applyInArrow(*_cogrouped(_answer(words), _ANSWERED))
    return dealt.groupBy("piece").cogroup(answers.withColumnRenamed("piece", "asker").groupBy("asker")).applyInArrow(*_cogrouped(
        _losses(words, model.size, model.sizes, model.prior),
        f"id {kind}, n_words bigint, target_loss double, background_loss double, score double"))


def score_documents(docs: DataFrame, model: BigramPair, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, target_loss, background_loss, score)`` for every row, of
    whole texts; a text without a word (null too) has losses and score 0. A row
    that a model counts (a target id, or a sampled row) is scored without its own
    counts, as far as the model has them; so is each of several rows alike. Repeated rows and null ids stay; no
    rows: no rows."""
    return _score(_dealt(_rows(docs, id_col, text_col), model.marks, model.buckets), model)


def score_against(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """:func:`fit_pair` and :func:`score_documents` on the same documents, which
    are dealt into pieces once."""
    model, dealt = _fit(docs, target, id_col, text_col, **{"size": None, "bits": None, "prior": PRIOR, **options})
    return _score(dealt, model)
