"""Toxicity by a classifier chain of linear models.

The categories are "the label, in group g" for each group (language) with
enough labelled cases, then the label as such. Each category has a logistic
model over hashed words and word beginnings; besides those it sees the
probabilities of all earlier categories. While training, a row's earlier
probabilities come from models that did not see the row (out of fold), so a
later model learns how far they can be trusted on new texts.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.runtime import map_texts
from tierflow.llm.sampling import first_by_hash
from tierflow.llm.words import Piece

BITS = 20
#: Labelled rows that the models are fitted on (a hash sample beyond that).
SAMPLE = 6000
#: Features kept, an equal share for each category: those that tell it best.
FEATURES = 768
FOLDS = 3
#: Weight of a case against a clean row.
CASE_WEIGHT = 3.0
#: Labelled cases (of the sample) that a group needs to become a category; the
#: sample bounds the number of categories. Fewer are told by the last category alone.
MIN_CASES = 30
#: Features that a category has at least, however many categories there are.
LEAST_FEATURES = 32
_PREFIXES = (4, 5, 6, 7, 8)


def word_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text index, feature) of every word and word beginning, repeats included."""
    p = Piece(texts)
    doc, feature = [p.doc], [p.hashes()]
    for n in _PREFIXES:
        at, h = p.prefixes(n)
        doc.append(p.doc[at])
        feature.append(h)
    return np.concatenate(doc), (np.concatenate(feature) >> np.uint64(64 - BITS)).astype(np.int64)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(row: np.ndarray, column: np.ndarray, value: np.ndarray, shape: tuple[int, int], y: np.ndarray,
                 weight: np.ndarray, l2: float = 5e-5, rounds: int = 150) -> np.ndarray:
    """Several logistic models over one sparse matrix:
    model m uses the rows with ``weight[:, m]``. Accelerated gradient descent."""
    models = weight.shape[1]

    def times(w):  # matrix x w
        return np.stack([np.bincount(row, weights=value * w[column, m], minlength=shape[0]) for m in range(w.shape[1])], axis=1)

    def back(r):  # transposed matrix x r
        return np.stack([np.bincount(column, weights=value * r[row, m], minlength=shape[1]) for m in range(r.shape[1])], axis=1)

    n = np.maximum(weight.sum(axis=0), 1)
    v = np.ones((shape[1], 1))
    for _ in range(8):  # largest curvature
        v = back(times(v))
        v /= max(np.linalg.norm(v), 1e-9)
    step = 1 / (0.25 * np.linalg.norm(times(v)) ** 2 * weight.max() / n.min() + l2)
    w = np.zeros((shape[1], models))
    ahead, t = w.copy(), 1.0
    for _ in range(rounds):
        grad = back((sigmoid(times(ahead)) - y[:, None]) * weight / n) + l2 * ahead
        new = ahead - step * grad
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t2 * (new - w)
        w, t = new, t2
    return w


@dataclass
class ToxicityChain:
    """``column``: a feature's place or -1; ``weights[k]``: of the features, the
    constant, then the earlier categories' probabilities."""

    categories: list[str]
    column: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray] = field(default_factory=list)

    def predict(self, texts: list[str]) -> np.ndarray:
        """(texts, categories) probabilities."""
        doc, feature = word_features(texts)
        at = self.column[feature]
        both = np.unique(doc[at >= 0] * len(self.scale) + at[at >= 0])  # present or not
        doc, at = both // max(1, len(self.scale)), both % max(1, len(self.scale))
        out = np.zeros((len(texts), len(self.categories)))
        for k, w in enumerate(self.weights):
            z = np.bincount(doc, weights=self.scale[at] * w[at], minlength=len(texts)) + w[len(self.scale)]
            out[:, k] = sigmoid(z + out[:, :k] @ w[len(self.scale) + 1:])
        return out


def _sample_rows(texts, cols):
    doc, feature = word_features(texts)
    both = np.unique(doc << BITS | feature)
    ends = np.cumsum(np.bincount(both >> BITS, minlength=len(texts)))
    ids = (both & ((1 << BITS) - 1)).astype("<i4")
    parts = [ids[a:z].tobytes() for a, z in zip([0, *ends[:-1].tolist()], ends.tolist())]
    return {"key": cols["key"], "label": cols["label"], "group": cols["group"], "ids": parts}


def fit_chain(docs: DataFrame, labels: DataFrame, label: str = "toxic", group: str = "lang", id_col: str = "doc_id",
              text_col: str = "text", sample: int = SAMPLE, features: int = FEATURES) -> ToxicityChain:
    """Learn from the rows of ``docs`` that ``labels`` (id, label 0 or 1) covers.

    Rows with a null label, id or text are left out; of an id labelled twice
    the larger label holds. ``sample`` bounds the labelled rows used. Without
    both kinds of rows every probability is the share of cases (0 if no rows).
    """
    marked = labels.select(F.col(id_col).cast("string").alias("key"), F.col(label).cast("int").alias("label")).filter(
        "key is not null and label is not null")
    marked = first_by_hash(marked, sample, "key").groupBy("key").agg(F.max("label").alias("label"))
    rows = docs.select(F.col(id_col).cast("string").alias("key"), F.col(text_col).alias("text"),
                       F.col(group).cast("string").alias("group")).filter(F.col("text").isNotNull())
    rows = rows.join(F.broadcast(marked), "key")  # at most 2 x sample narrow rows
    rows = first_by_hash(rows.select("text", "key", "label", "group"), 2 * sample, "key", "text")
    got = map_texts(rows, _sample_rows, "key string, label int, group string, ids binary").collect()
    return fit_rows(got, label, features)


def fit_rows(got: list, label: str, features: int = FEATURES) -> ToxicityChain:
    """Fit the chain on sample rows (key, label, group, ids)."""
    got = sorted(got, key=lambda r: (r["key"], bytes(r["ids"])))
    truth = np.array([r["label"] for r in got], np.float32) > 0
    groups = np.array([r["group"] or "" for r in got], dtype=object)
    sizes = {g: int((truth & (groups == g)).sum()) for g in {*groups[truth].tolist()} - {""}}
    chosen = [g for g, n in sorted(sizes.items(), key=lambda x: (-x[1], x[0])) if n >= MIN_CASES]
    categories = [f"{label}_{g}" for g in chosen] + [label]
    targets = [truth & (groups == g) for g in chosen] + [truth]

    ids = [np.frombuffer(r["ids"], "<i4") for r in got]
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(ids)), [len(i) for i in ids])
    seen = np.bincount(flat, minlength=1 << BITS).astype(np.float64)
    n, top = max(len(got), 1), np.zeros(0, np.int64)
    for y in targets:  # chi-squared of feature and category
        hit, share = np.bincount(flat[y[doc]], minlength=1 << BITS), y.sum() / n
        if 0 < share < 1:
            chi = (hit - seen * share) ** 2 * n / np.maximum(seen * (n - seen) * share * (1 - share), 1e-9)
            chi[(seen < 3) | (seen == n)] = 0
            first = np.lexsort((np.arange(1 << BITS), -chi))[:max(LEAST_FEATURES, features // len(targets))]
            top = np.union1d(top, first[chi[first] > 0])
    column = np.full(1 << BITS, -1, np.int64)
    column[top] = np.arange(len(top))
    scale = (1 / np.sqrt(np.maximum(seen[top] / n, 0.01))).astype(np.float32)
    model = ToxicityChain(categories, column, scale)
    if not 0 < truth.sum() < len(truth):
        share = float(truth.mean()) if len(truth) else 0.0
        for k in range(len(categories)):
            w = np.zeros(len(top) + 1 + k)
            w[len(top)] = 30 * (2 * share - 1)
            model.weights.append(w)
        return model
    at, rows = column[flat], np.arange(len(got))
    row = np.concatenate([doc[at >= 0], rows])
    col = np.concatenate([at[at >= 0], np.full(len(got), len(top))])
    value = np.concatenate([scale[at[at >= 0]], np.ones(len(got))])
    # by the text's features, so that copies of a text lie in one fold
    fold = np.fromiter((zlib.crc32(bytes(r["ids"])) % FOLDS for r in got), np.int64, len(got))
    weight = np.stack([fold != f for f in range(FOLDS)] + [np.ones(len(got), bool)], axis=1).astype(np.float64)
    for k, y in enumerate(targets):
        shape = (len(got), len(top) + 1 + k)
        w = fit_logistic(row, col, value, shape, y.astype(np.float64), weight * np.where(y, CASE_WEIGHT, 1)[:, None])
        model.weights.append(w[:, FOLDS])
        if k + 1 < len(categories):  # out-of-fold probabilities are the next feature
            z = np.bincount(row, weights=value * w[col, fold[row]], minlength=len(got))
            row, col = np.concatenate([row, rows]), np.concatenate([col, np.full(len(got), shape[1])])
            value = np.concatenate([value, sigmoid(z)])
    return model


def score_toxicity(docs: DataFrame, model: ToxicityChain, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = 0.5) -> DataFrame:
    """``(id, categories map<string, double>, score, toxic)`` for every row, of
    whole texts; ``score`` is the probability of the last category. A null text
    counts as empty; repeated rows and null ids stay; no rows: no rows."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 8 MB and the bounded weights

    def predict(texts, cols):
        m = shared.value
        p = m.predict(texts)
        return {"id": cols["id"], "categories": [list(zip(m.categories, x)) for x in p.tolist()],
                "score": p[:, -1], "toxic": p[:, -1] >= threshold}

    return map_texts(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), predict,
                     f"id {kind}, categories map<string,double>, score double, toxic boolean")


def keep_clean(docs: DataFrame, model: ToxicityChain, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with all their columns."""
    from pyspark.sql.functions import pandas_udf
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("boolean")
    def clean(texts):
        import pandas as pd

        from tierflow.llm.runtime import pieces
        texts = [t or "" for t in texts]
        return pd.Series(np.concatenate([shared.value.predict(texts[a:z])[:, -1] < threshold
                                         for a, z in pieces(texts)]) if texts else np.zeros(0, bool))
    return docs.filter(clean(F.col(text_col)))
