"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of 64 words. Every passage is encoded (hashed
character pairs and counts of its form, then a learned layer), gated attention
gives each a weight, and the weighted mean of the encodings is scored. Labels
exist for documents only; the attention learns which passages tell.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.runtime import map_texts
from tierflow.llm.sampling import at_most
from tierflow.llm.words import Piece, mix

#: Words of a passage.
PASSAGE = 64
PAIRS, FORMS = 160, 12
INPUTS = PAIRS + FORMS
HIDDEN, GATE = 24, 12
#: Labelled documents that the model is fitted on (a hash sample beyond that).
SAMPLE = 4000
EPOCHS, BATCH, RATE, DECAY = 30, 64, 0.01, 1e-4


def passages(texts: list[str], size: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """(features, text index) of all passages of whole texts, in order.

    A passage is ``size`` words (runs of other than white space) and what stands
    between them; every text has one at least, of zeros if it is empty.
    """
    p = Piece(texts, lower=False)
    body = p.cp != 0
    body[p.doc_at[1:] - 1] = False  # the separators
    space = p.member("space")
    p.split(body & ~space)
    first = np.searchsorted(p.doc, np.arange(p.n))  # each text's first word
    nth = np.arange(len(p.start)) - first[p.doc]
    lead = (nth % size == 0) & (nth > 0)
    mark = np.zeros(len(p.cp), np.int64)
    mark[p.start[lead]] = 1
    mark[p.doc_at[:-1]] = 1
    of_char = np.cumsum(mark) - 1
    n = int(of_char[-1]) + 1 if len(of_char) else 0
    doc = np.searchsorted(p.doc_at, np.flatnonzero(mark), side="right") - 1
    of_word = of_char[p.start]

    x = np.zeros((n, INPUTS), np.float32)
    pair = body[:-1] & body[1:] & (of_char[:-1] == of_char[1:])
    a, b = p.cp[:-1][pair].astype(np.uint64), p.cp[1:][pair].astype(np.uint64)
    bucket = (mix(a << np.uint64(32) | b) % np.uint64(PAIRS)).astype(np.int64)
    counts = np.bincount(of_char[:-1][pair] * PAIRS + bucket, minlength=n * PAIRS).reshape(n, PAIRS)
    x[:, :PAIRS] = np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)) * 4

    chars = np.maximum(np.bincount(of_char[body], minlength=n), 1)
    words = np.bincount(of_word, minlength=n)
    some = np.maximum(words, 1)

    def share(member: np.ndarray) -> np.ndarray:
        return np.bincount(of_char[member & body], minlength=n) / chars

    letter, digit = p.member("letter"), p.member("digit")
    h = p.hashes() if len(p.start) else np.zeros(0, np.uint64)
    key = np.sort(of_word.astype(np.uint64) << np.uint64(40) | h >> np.uint64(24))
    new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
    group = (key >> np.uint64(40)).astype(np.int64)
    runs = np.diff(np.append(np.flatnonzero(new), len(key)))
    most = np.zeros(n)
    np.maximum.at(most, group[new], runs)
    again = np.concatenate([[False], (h[1:] == h[:-1]) & (of_word[1:] == of_word[:-1])]) if len(h) else np.zeros(0, bool)
    last = p.cp[p.start + p.length - 1] if len(p.start) else np.zeros(0, np.uint32)
    plain_end = letter[p.start + p.length - 1] if len(p.start) else np.zeros(0, bool)
    forms = [
        share(letter), share(p.member("upper")), share(digit), share(space), share(~letter & ~digit & ~space),
        share(p.cp > 127), np.minimum(np.bincount(of_word, weights=p.length, minlength=n) / some / 10, 3),
        np.bincount(group[new], minlength=n) / some, most / some, np.bincount(of_word[again], minlength=n) / some,
        np.bincount(of_word[~plain_end & (last != 46) & (last != 44)], minlength=n) / some, words / size]
    for k, v in enumerate(forms):
        x[:, PAIRS + k] = v
    return x, doc


def _softmax_by(z: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    top = np.full(n, -np.inf)
    np.maximum.at(top, doc, z)
    e = np.exp(z - top[doc])
    return e / np.bincount(doc, weights=e, minlength=n)[doc]


@dataclass
class QualityModel:
    mean: np.ndarray
    spread: np.ndarray
    p: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, doc: np.ndarray, n: int) -> dict[str, np.ndarray]:
        p, x = self.p, (x - self.mean) / self.spread
        h = np.tanh(x @ p["enc"] + p["enc0"])
        t, s = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-np.clip(h @ p["u"], -30, 30)))
        a = _softmax_by((t * s) @ p["w"], doc, n)
        z = np.zeros((n, HIDDEN))
        np.add.at(z, doc, a[:, None] * h)
        return {"x": x, "h": h, "t": t, "s": s, "a": a, "z": z, "out": 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["c0"], -30, 30)))}

    def gradient(self, x, doc, n, y) -> dict[str, np.ndarray]:
        """Of the mean log loss."""
        p, f = self.p, self.forward(x, doc, n)
        d = (f["out"] - y) / n
        g = {"c": f["z"].T @ d, "c0": d.sum()}
        dz = d[:, None] * p["c"]  # to the weighted mean
        da = np.einsum("ij,ij->i", dz[doc], f["h"])
        da = f["a"] * (da - np.bincount(doc, weights=f["a"] * da, minlength=n)[doc])  # through the softmax
        gate = f["t"] * f["s"]
        g["w"] = gate.T @ da
        dg = da[:, None] * p["w"]
        dt, ds = dg * f["s"] * (1 - f["t"] ** 2), dg * f["t"] * f["s"] * (1 - f["s"])
        g["v"], g["u"] = f["h"].T @ dt, f["h"].T @ ds
        dh = (f["a"][:, None] * dz[doc] + dt @ p["v"].T + ds @ p["u"].T) * (1 - f["h"] ** 2)
        g["enc"], g["enc0"] = f["x"].T @ dh, dh.sum(axis=0)
        return g

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score of each text, its number of passages, and its largest weight."""
        x, doc = passages(texts)
        f = self.forward(x, doc, len(texts))
        top = np.zeros(len(texts))
        np.maximum.at(top, doc, f["a"])
        return f["out"], np.bincount(doc, minlength=len(texts)), top


def new_model(mean: np.ndarray, spread: np.ndarray, seed: int = 7) -> QualityModel:
    r = np.random.default_rng(seed)
    return QualityModel(mean, spread, {
        "enc": r.normal(size=(INPUTS, HIDDEN)) / np.sqrt(INPUTS), "enc0": np.zeros(HIDDEN),
        "v": r.normal(size=(HIDDEN, GATE)) / np.sqrt(HIDDEN), "u": r.normal(size=(HIDDEN, GATE)) / np.sqrt(HIDDEN),
        "w": r.normal(size=GATE) * 0.1, "c": r.normal(size=HIDDEN) * 0.1, "c0": np.zeros(())})


def fit_bags(bags: list[np.ndarray], y: np.ndarray) -> QualityModel:
    """Adam on small batches of whole bags, in a seeded order."""
    if not bags:
        return new_model(np.zeros(INPUTS), np.ones(INPUTS))
    x = np.concatenate(bags).astype(np.float32)
    model = new_model(x.mean(axis=0), x.std(axis=0) + 0.05)
    sizes = np.array([len(b) for b in bags])
    ends = np.cumsum(sizes)
    r = np.random.default_rng(11)
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    v = {k: np.zeros_like(v) for k, v in model.p.items()}
    step = 0
    for epoch in range(EPOCHS):
        order = r.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            pick = order[at:at + BATCH]
            rows = np.concatenate([np.arange(ends[i] - sizes[i], ends[i]) for i in pick])
            g = model.gradient(x[rows], np.repeat(np.arange(len(pick)), sizes[pick]), len(pick), y[pick])
            step += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for k, w in model.p.items():
                d = g[k] + DECAY * w
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.999 * v[k] + 0.001 * d * d
                model.p[k] = w - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def _bags(texts, cols):
    x, doc = passages(texts)
    ends = np.cumsum(np.bincount(doc, minlength=len(texts))).tolist()
    return {"key": cols["key"], "label": cols["label"],
            "bag": [x[a:z].astype("<f2").tobytes() for a, z in zip([0, *ends[:-1]], ends)]}


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id",
                text_col: str = "text", sample: int = SAMPLE) -> QualityModel:
    """Learn from the rows of ``docs`` that ``labels`` (id, label 0 or 1) covers.

    ``sample`` bounds the labelled documents used; of an id labelled twice the
    larger label holds; rows with a null label, id or text are left out. No
    rows: an untrained model, which answers about one half.
    """
    marked = labels.select(F.col(id_col).cast("string").alias("key"), F.col(label).cast("int").alias("label")).filter(
        "key is not null and label is not null")
    marked = at_most(marked, sample, "key").groupBy("key").agg(F.max("label").alias("label"))
    rows = docs.select(F.col(id_col).cast("string").alias("key"), F.col(text_col).alias("text")).filter(
        F.col("text").isNotNull()).join(F.broadcast(marked), "key")
    got = map_texts(rows.select("text", "key", "label"), _bags, "key string, label int, bag binary").limit(2 * sample).collect()
    got.sort(key=lambda r: (r["key"], bytes(r["bag"])))
    bags = [np.frombuffer(r["bag"], "<f2").reshape(-1, INPUTS) for r in got]
    return fit_bags(bags, np.array([float(r["label"] > 0) for r in got]))


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score, n_passages, top_weight)`` for every row, from its whole
    text alone; a null text counts as empty; repeated rows and null ids stay;
    no rows: no rows."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some 40 KB

    def predict(texts, cols):
        score, n, top = shared.value.predict(texts)
        return {"id": cols["id"], "score": score, "n_passages": n, "top_weight": top}

    return map_texts(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), predict,
                     f"id {kind}, score double, n_passages bigint, top_weight double")
