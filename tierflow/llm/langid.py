"""Language identification by nearest centroid.

A text is a normalised TF-IDF vector of hashed character 1- to 3-grams. Each
language has several centroids, found by clustering its sample; a text gets
the language of the centroid with the largest cosine. ``rejected`` marks texts
farther from it than (nearly) all of the cluster's own sample texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.runtime import map_texts
from tierflow.llm.sampling import _SCALE, chance
from tierflow.llm.words import Piece, mix, powers

BITS = 14
SIZE = 1 << BITS
#: Sample texts per language that centroids are fitted on (the document
#: frequencies come from all learnable texts).
PER_LANGUAGE = 800
CLUSTERS = 4
UNKNOWN = "und"
#: Texts whose vectors are dense at one time.
_DENSE = 256


def gram_counts(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per whole text: the hashed n-grams it has, ascending, and their counts.

    Runs of other than letters count as one space; each text begins and ends
    with one. A text without a letter has none.
    """
    p = Piece(texts)
    letter = p.member("letter")
    c = np.where(letter, p.cp, 32).astype(np.uint64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one space behind every word
    at = np.flatnonzero(keep)
    doc = np.searchsorted(p.doc_at, at, side="right") - 1
    c, power = c[at], powers(4)
    grams = []
    for n in (1, 2, 3):
        m = len(c) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, np.uint64)
        for k in range(n):
            h += c[k:k + m] * power[k + 1]
        same = doc[:m] == doc[n - 1:]
        if n == 1:
            same = letter[at]
        grams.append((doc[:m][same], (mix(h[same]) >> np.uint64(64 - BITS)).astype(np.int64)))
    if not grams:
        return [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(texts)
    doc, gram = np.concatenate([g[0] for g in grams]), np.concatenate([g[1] for g in grams])
    order = np.argsort(doc, kind="stable")
    gram, ends = gram[order], np.cumsum(np.bincount(doc, minlength=len(texts)))
    out, a = [], 0
    for z in ends.tolist():
        counts = np.bincount(gram[a:z], minlength=SIZE) if z > a else np.zeros(0, np.int64)
        ids = np.flatnonzero(counts)
        out.append((ids, counts[ids]))
        a = z
    return out


def vectors(counted: list, idf: np.ndarray) -> np.ndarray:
    """Dense unit vectors, (1 + ln count) x idf; nothing known: zero."""
    x = np.zeros((len(counted), SIZE), np.float32)
    for i, (ids, counts) in enumerate(counted):
        x[i, ids] = (1 + np.log(counts)) * idf[ids]
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


def clusters(x: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: unit centroids and the lowest cosine that all but a
    hundredth of their members reach. The first centre is the mean, then each
    the member worst covered, so the result is the same for the same rows."""
    centre = x.mean(axis=0, keepdims=True)
    centre /= max(np.linalg.norm(centre), 1e-12)
    while len(centre) < min(k, len(x)):
        centre = np.vstack([centre, x[(x @ centre.T).max(axis=1).argmin()][None]])
    for _ in range(rounds):
        own = (x @ centre.T).argmax(axis=1)
        kept = [x[own == j].mean(axis=0) for j in range(len(centre)) if (own == j).any()]
        centre = np.stack([c / max(np.linalg.norm(c), 1e-12) for c in kept])
    cos = x @ centre.T
    own, best = cos.argmax(axis=1), cos.max(axis=1)
    reach = [np.quantile(best[own == j], 0.01) if (own == j).any() else 1.0 for j in range(len(centre))]
    return centre, np.array(reach)


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # (n, SIZE)
    owner: np.ndarray  # index of each centroid's language
    reach: np.ndarray  # lowest cosine of its own sample texts

    def predict(self, texts: list[str], slack: float = 0.5) -> dict[str, list]:
        """lang, score (cosine with the nearest centroid, 0 to 1), rejected."""
        lang, score, rejected = [], [], []
        counted = gram_counts(texts)
        for a in range(0, len(texts), _DENSE):
            some = counted[a:a + _DENSE]
            if len(self.centroids):
                cos = vectors(some, self.idf) @ self.centroids.T
                best = cos.argmax(axis=1)
                top = np.clip(cos[np.arange(len(some)), best], 0, 1)
            for i, (ids, _) in enumerate(some):
                if not len(ids) or not len(self.centroids):
                    lang.append(UNKNOWN), score.append(0.0), rejected.append(True)
                else:
                    lang.append(self.languages[self.owner[best[i]]])
                    score.append(float(top[i]))
                    rejected.append(bool(top[i] < slack * self.reach[best[i]]))
        return {"lang": lang, "score": score, "rejected": rejected}


def _document_frequency(batches):
    total = np.zeros(SIZE, np.int64)
    texts_seen = 0
    for b in batches:
        texts = [t or "" for t in b.column(0).to_pylist()]
        from tierflow.llm.runtime import pieces
        for a, z in pieces(texts):
            for ids, _ in gram_counts(texts[a:z]):
                total[ids] += 1
        texts_seen += len(texts)
    if texts_seen:
        gram = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(gram, -1), pa.int32()),
                                          pa.array(np.append(total[gram], texts_seen), pa.int64())], names=["gram", "n"])


def _sample_rows(texts, cols):
    counted = gram_counts(texts)
    return {"lang": cols["lang"], "order": cols["order"], "ids": [i.astype("<i4").tobytes() for i, _ in counted],
            "counts": [c.astype("<i4").tobytes() for _, c in counted]}


def fit_languages(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                  per_language: int = PER_LANGUAGE, n_clusters: int = CLUSTERS) -> LanguageModel:
    """Learn from the rows of ``docs`` with a language and a letter.

    Document frequencies count every such row; centroids are fitted on about
    ``per_language`` of each language's texts, chosen by hash (rows that repeat
    one text are chosen together: at most twice that many count). No usable
    rows: a model without languages, which answers ``und``.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull())
    df = rows.select("text").mapInArrow(_document_frequency, "gram int, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    found = {r["gram"]: r["n"] for r in df.collect()}  # SIZE + 1 rows at most
    total = found.pop(-1, 0)
    idf = np.full(SIZE, np.log(1 + total) + 1, np.float32)
    for g, n in found.items():
        idf[g] = np.log((1 + total) / (1 + n)) + 1

    sizes = {r["lang"]: (r["n"], r["least"]) for r in rows.groupBy("lang").agg(
        F.count("*").alias("n"), F.min(chance("text")).alias("least")).collect()}
    if not sizes:
        return LanguageModel([], idf, np.zeros((0, SIZE), np.float32), np.zeros(0, int), np.zeros(0))
    # the first text of a language by its hash is always taken, however few texts it has
    rates = spark.createDataFrame([(k, max(int(min(1.0, per_language / n) * _SCALE), least + 1)) for k, (n, least) in sizes.items()],
                                  "lang string, rate bigint")
    # rates have a row for each language; texts are not dealt by language
    picked = rows.join(F.broadcast(rates), "lang").withColumn("order", chance("text")).filter("order < rate")
    # rows that repeat one text without end take no place of another language
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("order", F.xxhash64("text")))
    picked = picked.withColumn("nth", nth).filter(F.col("nth") <= 2 * per_language)
    sample = map_texts(picked.select("text", "lang", "order"), _sample_rows,
                       "lang string, order bigint, ids binary, counts binary")
    by: dict[str, list] = {}
    for r in sorted(sample.collect(), key=lambda r: (r["lang"], r["order"], bytes(r["ids"]), bytes(r["counts"]))):
        ids = np.frombuffer(r["ids"], "<i4")
        if len(ids) and len(by.setdefault(r["lang"], [])) < 2 * per_language:
            by[r["lang"]].append((ids, np.frombuffer(r["counts"], "<i4")))
    languages, centroids, owner, reach = [], [], [], []
    for lang in sorted(by):
        if by[lang]:
            c, low = clusters(vectors(by[lang], idf), n_clusters)
            owner += [len(languages)] * len(c)
            languages.append(lang)
            centroids.append(c)
            reach.append(low)
    if not languages:
        return LanguageModel([], idf, np.zeros((0, SIZE), np.float32), np.zeros(0, int), np.zeros(0))
    return LanguageModel(languages, idf, np.vstack(centroids).astype(np.float32), np.array(owner), np.concatenate(reach))


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text",
             slack: float = 0.5) -> DataFrame:
    """``(id, lang, score, rejected)`` for every row: the nearest language,
    its cosine, and whether the text is farther away than ``slack`` times the
    reach of that centroid. A null text, or one without a letter: ``und``, 0,
    rejected. Ties go to the first language by name. Repeated rows and null ids
    stay; an empty table gives an empty result."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # n_clusters x languages x 64 KB

    def predict(texts, cols):
        return {"id": cols["id"], **shared.value.predict(texts, slack)}

    return map_texts(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), predict,
                     f"id {kind}, lang string, score double, rejected boolean")
