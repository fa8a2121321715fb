"""Alignment of two tokenizers' tokens over the same bytes, and how often pairs
of ids are linked in the corpus.

Tokens of both sides are intervals of a batch's bytes. They are sorted by start
together and the running maximum of their ends is taken: a group breaks where a
start reaches it. Tokens of one group are linked, each of one side with each of
the other. Documents are dealt into pieces of bounded size; a piece's distinct
pairs are counted by Spark over all pieces and come back to it, so that no
document's pairs are shuffled one by one and no pair's documents meet in a task.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.bpe import ByteBPE, Spelling, word_pattern
from tierflow.llm.runtime import pieces, written
from tierflow.llm.transducer import spread

#: Characters and documents of one piece at most (a longer text goes alone).
PIECE_CHARS, PIECE_DOCS = 4 << 20, 4096
#: Links that one step expands.
STEP_LINKS = 1 << 22
#: Words whose ids a worker remembers; beyond it the memory starts anew.
REMEMBERED = 300_000

_LOADED: dict[str, "PieceBPE"] = {}


class PieceBPE:
    """A sentencepiece file whose pieces hold spaces only before other
    characters: ids of a text are then those of its parts, each a run of spaces
    and what follows, one after another."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in names) or self.sp.encode("  a", out_type=str)[:1] == ["▁a"]:
            raise ValueError(f"{path}: parts of a text can't be encoded one by one")
        self.spelling = [bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.space = self.sp.piece_to_id("▁")
        self.parts = re.compile(" +[^ ]*").findall

    @classmethod
    def of(cls, path: str) -> "PieceBPE":
        if path not in _LOADED:
            _LOADED[path] = cls(path)
        return _LOADED[path]

    def ids_of(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # the file puts a space before what it encodes, and nothing before nothing
        made = [ids or [self.space] for ids in self.sp.encode([p[1:] for p in parts], num_threads=1)]
        count = np.fromiter(map(len, made), np.int64, len(made))
        return count, np.fromiter(chain.from_iterable(made), np.int64, int(count.sum()))


class Words:
    """Ids of words, which are asked for once as long as they are remembered."""

    def __init__(self, ids_of):
        self.ids_of = ids_of
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.count = self.start = self.ids = np.zeros(0, np.int64)

    def encode(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts given as words, one after another, and where each text
        begins (one entry more than texts)."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        words = list(chain.from_iterable(texts))
        new = list(set(words).difference(self.number))
        if len(self.number) + len(new) > REMEMBERED:
            self.forget()
            new = list(set(words))
        count, ids = self.ids_of(new)
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        self.count, self.ids = np.concatenate([self.count, count]), np.concatenate([self.ids, ids])
        self.start = np.cumsum(self.count) - self.count
        at = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        count = self.count[at]
        return self.ids[spread(self.start[at], count)], np.concatenate([[0], np.cumsum(count)])[np.concatenate([[0], np.cumsum(sizes)])]


class Aligner:
    """Tokens and groups of texts under a byte-level and a sentencepiece file."""

    def __init__(self, a_path: str, b_path: str, pattern: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a, self.b = ByteBPE.of(a_path, pattern, None, False), PieceBPE.of(b_path)
        self.words_a, self.words_b = Words(self.a.ids_of), Words(self.b.ids_of)
        self.bytes_a, self.bytes_b = Spelling(self.a.spelling), Spelling(self.b.spelling)
        self.size_a, self.size_b = self.bytes_a.size, self.bytes_b.size
        # ids written out: of a inside a group, of a at its end, of b inside, of b at the end
        self.said = np.array([f"{i}{end}" for n, ends in ((len(self.size_a), ",|"), (len(self.size_b), ",;")) for end in ends for i in range(n)], object)

    def spelt(self, texts: list[str], ids_a, at_a, ids_b, at_b) -> np.ndarray:
        """Which texts both sides' tokens spell."""
        raw = [t.encode() for t in texts]
        good = np.fromiter(map(len, raw), np.int64, len(raw)) > 0
        for table, ids, at in ((self.bytes_a, ids_a, at_a), (self.bytes_b, ids_b, at_b)):
            made, edge = table.join(ids)
            cut = edge[at].tolist()
            good &= np.fromiter((made[x:y] == r for x, y, r in zip(cut, cut[1:], raw)), bool, len(raw))
        return good

    def align(self, texts: list[str]) -> dict:
        """Per text counts and the digest of its groups, and its linked pairs of
        ids with their links: ``pair`` (a's id above 32 bits of b's), ``links``
        and ``edge``, where each text's pairs begin; pairs of a text ascend."""
        texts = [" " + t if t else "" for t in texts]
        ids_a, at_a = self.words_a.encode([self.a.words(t) for t in texts])
        ids_b, at_b = self.words_b.encode([self.b.parts(t) for t in texts])
        n = len(texts)
        good = self.spelt(texts, ids_a, at_a, ids_b, at_b)
        n_a, n_b = (np.where(good, np.diff(at), 0) for at in (at_a, at_b))
        ids_a, ids_b = ids_a[np.repeat(good, np.diff(at_a))], ids_b[np.repeat(good, np.diff(at_b))]

        # intervals of both sides on one axis of bytes, by start; a wins no tie that matters
        size = np.concatenate([self.size_a[ids_a], self.size_b[ids_b]])
        side = np.repeat(np.array([0, 1], np.int8), [len(ids_a), len(ids_b)])
        end = np.concatenate([np.cumsum(size[:len(ids_a)]), np.cumsum(size[len(ids_a):])])
        order = np.lexsort((side, end - size))
        reach = np.maximum.accumulate(end[order])
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum((end - size)[order] >= np.concatenate([[0], reach[:-1]])) - 1 if len(order) else 0
        g_a, g_b = group[:len(ids_a)], group[len(ids_a):]
        groups = int(group.max()) + 1 if len(group) else 0
        of_a, of_b = np.bincount(g_a, minlength=groups), np.bincount(g_b, minlength=groups)
        doc_a, doc_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
        first = np.cumsum(of_a) - of_a
        doc = doc_a[first] if groups else np.zeros(0, np.int64)
        n_groups = np.bincount(doc, minlength=n)
        n_links = np.bincount(doc, weights=of_a * of_b, minlength=n).astype(np.int64)
        pair, links, edge = self.pairs(ids_a, ids_b, of_a, of_b, doc, n)
        return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "pair": pair, "links": links, "edge": edge,
                "groups_sha256": self.digests(ids_a, ids_b, g_a, g_b, doc_a, doc_b, n, good)}

    def pairs(self, ids_a, ids_b, of_a, of_b, doc, n) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs of each text, with how many links each has."""
        first_a, first_b = np.cumsum(of_a) - of_a, np.cumsum(of_b) - of_b
        total = np.cumsum(of_a * of_b)
        docs, pair, links, a = [], [], [], 0
        while a < len(total):  # whole groups, of STEP_LINKS links or one group
            z = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + STEP_LINKS, "right")))
            if z == a + 1 and of_a[a] * of_b[a] > STEP_LINKS:
                # one long group: ids repeat in it, so pairs of distinct ids are far fewer than links
                x, m = np.unique(ids_a[first_a[a]:first_a[a] + of_a[a]], return_counts=True)
                y, k = np.unique(ids_b[first_b[a]:first_b[a] + of_b[a]], return_counts=True)
                p, w = (x[:, None] << 32 | y).ravel(), (m[:, None] * k).ravel()
                d = np.full(len(p), doc[a])
            else:
                m, k = of_a[a:z], of_b[a:z]
                left = spread(first_a[a:z], m)  # each token of a with all of its group's of b
                k_of = np.repeat(k, m)
                # one number for text and both ids: links that are alike are counted by sorting these alone
                x, y = len(self.size_a), len(self.size_b)
                one = (np.repeat(doc[a:z], m * k) * x + np.repeat(ids_a[left], k_of)) * y + ids_b[spread(np.repeat(first_b[a:z], m), k_of)]
                one, w = np.unique(one, return_counts=True)
                d, p = np.divmod(one, x * y)
                p = p // y << 32 | p % y
            for out, x in zip((docs, pair, links), (d, p, w)):
                out.append(x)
            a = z
        if not docs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
        d, p, w = docs[0], pair[0], links[0]
        if len(docs) > 1:
            d, p, w = summed(*(np.concatenate(x) for x in (docs, pair, links)))
        return p, w, np.searchsorted(d, np.arange(n + 1))

    def digests(self, ids_a, ids_b, g_a, g_b, doc_a, doc_b, n, good) -> list[str]:
        """SHA-256 of every text's groups, written out."""
        last = lambda g: np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool)
        end_a, end_b = last(g_a), last(g_b)
        word = np.concatenate([ids_a + end_a * len(self.size_a), ids_b + (2 * len(self.size_a) + end_b * len(self.size_b))])
        # by group, a's tokens before b's
        order = np.argsort(np.concatenate([g_a * 2, g_b * 2 + 1]), kind="stable")
        said = self.said[word[order]].tolist()
        edge = np.concatenate([[0], np.cumsum(np.bincount(doc_a, minlength=n) + np.bincount(doc_b, minlength=n))]).tolist()
        return [hashlib.sha256("".join(said[edge[i]:edge[i + 1]])[:-1].encode()).hexdigest() if good[i] else "" for i in range(n)]


def summed(doc: np.ndarray, pair: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows added up by (doc, pair), in that order."""
    order = np.lexsort((pair, doc))
    doc, pair = doc[order], pair[order]
    first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1]))) if len(doc) else np.zeros(0, np.int64)
    return doc[first], pair[first], np.add.reduceat(links[order], first) if len(first) else links


def packed(values: np.ndarray) -> bytes:
    """Small numbers as bytes, the lowest byte of all first, then the second
    ..., so that the zeros lie together and compress away."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


_DOC = ["n_a", "n_b", "n_groups", "n_links"]


def _align(a_path: str, b_path: str, pattern: str):
    """Rows of two kinds: one per document (``pairs``: places in its piece's
    pairs, as steps, and links of each), one per piece (its pairs, ascending,
    and how many documents hold each)."""
    def run(batches):
        aligner, held, ids, chars = Aligner(a_path, b_path, pattern), [], [], 0
        for b in batches:
            for at, text in enumerate(t or "" for t in b.column(1).to_pylist()):
                if held and (chars + len(text) > PIECE_CHARS or len(held) >= PIECE_DOCS):
                    yield from piece(aligner, held, ids)
                    held, ids, chars = [], [], 0
                held.append(text), ids.append(b.column(0).slice(at, 1))
                chars += len(text)
        if held:
            yield from piece(aligner, held, ids)

    def piece(aligner, texts, ids):
        name = uuid.uuid4().hex  # another attempt of the task writes other rows, of which one attempt's are kept
        got = [aligner.align(texts[a:z]) for a, z in pieces(texts)]
        pair = np.concatenate([g["pair"] for g in got])
        distinct, place, docs = np.unique(pair, return_inverse=True, return_counts=True)
        links = np.concatenate([g["links"] for g in got])
        sizes = np.concatenate([np.diff(g["edge"]) for g in got])
        edge = np.concatenate([[0], np.cumsum(sizes)]).tolist()
        n = len(texts)
        col = {k: pa.array(np.concatenate([g[k] for g in got]), pa.int64()) for k in _DOC}
        cuts = list(zip(edge, edge[1:]))
        # rows of documents, 512 at a time
        ids = pa.concat_arrays(ids)
        digests = [d for g in got for d in g["groups_sha256"]]
        for a in range(0, n, 512):
            z = min(n, a + 512)
            empty = [None] * (z - a)
            yield pa.RecordBatch.from_arrays([
                pa.array([name] * (z - a)), ids.slice(a, z - a), *[col[k].slice(a, z - a) for k in _DOC],
                pa.array(digests[a:z]), pa.array([packed(np.diff(place[x:y], prepend=0)) for x, y in cuts[a:z]], pa.binary()),
                pa.array([packed(links[x:y]) for x, y in cuts[a:z]], pa.binary()),
                pa.array(empty, pa.list_(pa.int64())), pa.array(empty, pa.list_(pa.int64()))], names=_NAMES)
        for a in range(0, len(distinct), 1 << 16):
            z = a + (1 << 16)
            yield pa.RecordBatch.from_arrays([
                pa.array([name]), pa.nulls(1, ids.type), *[pa.nulls(1, pa.int64()) for _ in _DOC], pa.nulls(1, pa.string()),
                pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                pa.array([distinct[a:z]], pa.list_(pa.int64())), pa.array([docs[a:z]], pa.list_(pa.int64()))], names=_NAMES)
    return run


_NAMES = ["piece", "id", *_DOC, "groups_sha256", "places", "links", "pair", "docs"]


def align_tokens(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two tables. ``counts(a_id, b_id, n_docs, best)``: every pair of ids that
    some document holds linked, in how many documents, and whether no other pair
    of its A id is in more. ``documents(id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256)``: one row per row of ``docs``.

    A document is a space and its text, by the byte-level file ``a_path``
    (special tokens' strings are plain text), and its text by the sentencepiece
    file ``b_path``, which adds the space. Null and empty texts, and texts whose
    tokens do not spell them (a U+2581 is one), have no tokens: zeros, and an
    empty digest. Ids may be null; repeated rows are documents of their own.
    Other columns are not read. An empty table gives empty results.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    aligned = written(rows.mapInArrow(_align(a_path, b_path, word_pattern()), (
        f"piece string, id {kind}, {', '.join(f'{k} bigint' for k in _DOC)}, groups_sha256 string, places binary, links binary, "
        "pair array<bigint>, docs array<bigint>")), "aligned")
    asked = aligned.filter("pair is not null").select("piece", F.explode(F.arrays_zip("pair", "docs")).alias("x"))
    asked = asked.select("piece", F.col("x.pair").alias("pair"), F.col("x.docs").alias("docs"))
    counts = asked.groupBy("pair").agg(F.sum("docs").alias("n_docs"))
    a_id = F.shiftright("pair", 32)
    most = counts.groupBy(a_id.alias("a_id")).agg(F.max("n_docs").alias("most"))  # a row for each id of the file at most
    counts = written(counts.withColumn("a_id", a_id).join(most, "a_id").select(
        "pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best")), "pair-counts")

    answers = asked.select(F.col("piece").alias("asker"), "pair").join(counts, "pair")

    def score(key, left, right):
        at = np.argsort(right.column("pair").to_numpy(), kind="stable")
        n = right.column("n_docs").to_numpy()[at]
        best = right.column("best").to_numpy(zero_copy_only=False)[at]
        out = {"n_best": [], "count_sum": []}
        for places, links in zip(left.column("places").to_pylist(), left.column("links").to_pylist()):
            places, links = np.cumsum(unpacked(places)), unpacked(links)
            out["n_best"].append(int(links[best[places]].sum()))
            out["count_sum"].append(int((links * n[places]).sum()))
        return pa.table([left.column("id"), *[left.column(k) for k in _DOC], pa.array(out["n_best"], pa.int64()),
                         pa.array(out["count_sum"], pa.int64()), left.column("groups_sha256")], names=_SCORED)
    documents = aligned.filter("places is not null").select("piece", "id", *_DOC, "groups_sha256", "places", "links")
    scored = documents.groupBy("piece").cogroup(answers.groupBy("asker")).applyInArrow(
        score, f"id {kind}, {', '.join(f'{k} bigint' for k in [*_DOC, 'n_best', 'count_sum'])}, groups_sha256 string")
    readable = counts.select(F.shiftright("pair", 32).cast("int").alias("a_id"), F.col("pair").bitwiseAND(0xFFFFFFFF).cast("int").alias("b_id"),
                             "n_docs", "best")
    return readable, scored


_SCORED = ["id", *_DOC, "n_best", "count_sum", "groups_sha256"]
