"""Document quality by attention over passages, learned from labels of whole documents.

Every text is cut into passages of PASSAGE words. A passage is encoded from its byte and word figures
and hashed word counts; gated attention weighs the encoded passages, and the weighted sum is scored
(multiple-instance learning). The network is trained on a bounded sample of labelled documents;
scoring reads all passages of every text, batch by batch in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.llm.batches import BLANK, Words, lean, mix, slices, text_buffers

PASSAGE = 64
#: Bins for hashed words.
BINS = 48
#: Labelled documents that the network is trained on at most, half of each label, first by a hash of the id.
SAMPLE_DOCUMENTS = 4_000
#: Passages of the longest document learned from, whole; scores read every passage of every text.
SAMPLE_PASSAGES = 1024
#: Bytes of features that reach the driver: documents in order of a hash of their id, up to here.
SAMPLE_BYTES = 96 << 20
HIDDEN, GATES, STEPS, BATCH, RATE, DECAY = 24, 12, 800, 128, 0.01, 1e-3

_WORDS = Words(BLANK, fold_case=False)
_CLASSES = np.zeros((7, 256), np.uint8)  # lower, upper, digit, stop, other mark, beyond ASCII, line end
_CLASSES[0, 97:123] = _CLASSES[1, 65:91] = _CLASSES[2, 48:58] = _CLASSES[5, 128:] = 1
_CLASSES[3, [ord(c) for c in ".,;:!?"]] = 1
_CLASSES[4, [c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:!?"]] = 1
_CLASSES[6, 10] = 1
FIGURES = 7 + 9
FEATURES = FIGURES + BINS


def passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and for each text the index of its first one (one more entry at the end); a text without words has one of zeros."""
    data, offsets = text_buffers(column)
    starts, ends = _WORDS.spans(data, offsets)
    hashes, firsts = _WORDS.hashes(data, offsets)
    n_words = np.diff(firsts)
    counts = np.maximum(1, -(-n_words // PASSAGE))
    heads = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros((int(heads[-1]), FEATURES), np.float32)
    if not len(starts):
        return out, heads
    text = np.repeat(np.arange(len(n_words)), n_words)
    passage = heads[text] + (np.arange(len(starts)) - firsts[text]) // PASSAGE
    begin = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
    own = passage[begin]
    size = np.diff(np.append(begin, len(starts))).astype(np.float32)
    lo, hi = starts[begin], ends[np.append(begin[1:], len(starts)) - 1]
    length = np.maximum(1, hi - lo).astype(np.float32)
    edges = np.stack([lo, np.minimum(hi, len(data) - 1)], axis=1).ravel()
    for k in range(7):
        # Odd places of reduceat hold what lies between passages; the last byte of a batch may be left out.
        sums = np.add.reduceat(_CLASSES[k][data].astype(np.int32), edges)[::2]
        out[own, k] = sums / length
    widths = (ends - starts).astype(np.float32)
    mean = np.add.reduceat(widths, begin) / size
    square = np.add.reduceat(widths * widths, begin) / size
    same = np.append(False, (hashes[1:] == hashes[:-1]) & (passage[1:] == passage[:-1])).astype(np.float32)
    order = np.lexsort((hashes, passage))
    fresh = np.append(True, (hashes[order][1:] != hashes[order][:-1]) | (passage[order][1:] != passage[order][:-1])).astype(np.float32)
    last, first = data[ends - 1], data[starts]
    figures = [
        size / PASSAGE,
        mean / 10,
        np.sqrt(np.maximum(0, square - mean * mean)) / 10,
        np.maximum.reduceat(widths, begin) / 50,
        np.add.reduceat(same, begin) / size,
        np.add.reduceat(fresh, begin) / size,
        np.add.reduceat(_CLASSES[3][last].astype(np.float32), begin) / size,
        np.add.reduceat(_CLASSES[4][last].astype(np.float32), begin) / size,
        np.add.reduceat((_CLASSES[0][first] == 0).astype(np.float32), begin) / size,
    ]
    for k, values in enumerate(figures):
        out[own, 7 + k] = values
    bins = (mix(hashes) >> np.uint64(40)) % np.uint64(BINS)
    table = np.bincount(passage * BINS + bins.astype(np.int64), minlength=len(out) * BINS).reshape(len(out), BINS)
    out[:, FIGURES:] = np.log1p(table) / 4
    return out, heads


@dataclass
class Network:
    """Weights; `mean` and `scale` of the features; `shift` corrects the sample's share of labels."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    shift: float

    def score(self, features: np.ndarray, heads: np.ndarray) -> np.ndarray:
        x = (features - self.mean) / self.scale
        logit = _forward(self.weights, np.clip(x, -8, 8), heads)["logit"] + self.shift
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _forward(w: dict[str, np.ndarray], x: np.ndarray, heads: np.ndarray) -> dict[str, np.ndarray]:
    begin, bag = heads[:-1], np.repeat(np.arange(len(heads) - 1), np.diff(heads))
    h = np.tanh(x @ w["encode"] + w["encode0"])
    t, s = np.tanh(h @ w["look"]), 1 / (1 + np.exp(-np.clip(h @ w["gate"], -30, 30)))
    e = (t * s) @ w["attend"]
    e = np.exp(e - np.maximum.reduceat(e, begin)[bag])
    a = e / np.add.reduceat(e, begin)[bag]
    z = np.add.reduceat(a[:, None] * h, begin, axis=0)
    return {"h": h, "t": t, "s": s, "a": a, "z": z, "bag": bag, "logit": z @ w["score"] + w["score0"]}


def _gradient(w: dict[str, np.ndarray], x: np.ndarray, heads: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    f = _forward(w, x, heads)
    h, t, s, a, bag = f["h"], f["t"], f["s"], f["a"], f["bag"]
    d_logit = (1 / (1 + np.exp(-np.clip(f["logit"], -30, 30))) - y) / len(y)
    d_z = d_logit[:, None] * w["score"]
    d_a = (h * d_z[bag]).sum(axis=1)
    d_e = a * (d_a - np.add.reduceat(a * d_a, heads[:-1])[bag])
    d_gated = d_e[:, None] * w["attend"]
    d_t, d_s = d_gated * s * (1 - t * t), d_gated * t * s * (1 - s)
    d_h = a[:, None] * d_z[bag] + d_t @ w["look"].T + d_s @ w["gate"].T
    d_pre = d_h * (1 - h * h)
    return {
        "encode": x.T @ d_pre, "encode0": d_pre.sum(axis=0), "look": h.T @ d_t, "gate": h.T @ d_s,
        "attend": (t * s).T @ d_e, "score": f["z"].T @ d_logit, "score0": np.array(d_logit.sum()),
    }


def train(features: np.ndarray, heads: np.ndarray, labels: np.ndarray, share: float) -> Network:
    """Adam on batches of documents. `share`: share of label 1 among all labelled documents."""
    rng = np.random.default_rng(7)
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-3
    x = np.clip((features - mean) / scale, -8, 8)
    w = {
        "encode": rng.normal(0, FEATURES**-0.5, (FEATURES, HIDDEN)), "encode0": np.zeros(HIDDEN), "look": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATES)),
        "gate": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATES)), "attend": rng.normal(0, GATES**-0.5, GATES), "score": rng.normal(0, HIDDEN**-0.5, HIDDEN), "score0": np.array(0.0),
    }
    first, second, step = {k: 0.0 for k in w}, {k: 0.0 for k in w}, 0
    while step < STEPS:
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            own = order[at : at + BATCH]
            sizes = (heads[1:] - heads[:-1])[own]
            rows = np.concatenate([np.arange(heads[k], heads[k + 1]) for k in own])
            g = _gradient(w, x[rows], np.concatenate([[0], np.cumsum(sizes)]), labels[own])
            step += 1
            for k in w:
                d = g[k] + DECAY * w[k]
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.999 * second[k] + 0.001 * d * d
                w[k] = w[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    own = float(labels.mean())
    odds = lambda p: np.log(p / (1 - p))
    return Network(mean, scale, w, float(odds(np.clip(share, 0.01, 0.99)) - odds(np.clip(own, 0.01, 0.99))))


@lean
def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole, 1, 4 << 20)):
        features, heads = passages(batch.column(1))
        rows = []
        for a, b in zip(heads[:-1].tolist(), heads[1:].tolist(), strict=True):
            rows.append(features[a:b].tobytes() if b - a <= SAMPLE_PASSAGES else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary()), batch.column(2)], names=["order", "features", "label"])


def fit(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Network | float:
    """The network, or a constant score where there is nothing to learn from.

    `labelled` has the document id and label (0 or 1); other labels, null ids and ids with differing
    labels are left out. At most SAMPLE_DOCUMENTS documents reach the driver, as features of all their
    passages, SAMPLE_BYTES in all; documents of over SAMPLE_PASSAGES passages are not learned from.
    """
    clean = labelled.where("label IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most")
    order = F.xxhash64("doc_id")
    totals = {r.label: r.n for r in clean.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return float(next(iter(totals), 0.5))
    half = SAMPLE_DOCUMENTS // 2
    picked = None
    for label in sorted(totals):
        own = clean.where(F.col("label") == label).select("doc_id", "label", order.alias("order")).orderBy("order", "doc_id").limit(half)
        picked = own if picked is None else picked.unionByName(own)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # At most SAMPLE_DOCUMENTS rows are broadcast.
    sample = texts.join(F.broadcast(picked), "doc_id").select("order", "text", F.col("label").cast("double").alias("label"))
    schema = T.StructType([T.StructField("order", T.LongType()), T.StructField("features", T.BinaryType()), T.StructField("label", T.DoubleType())])
    # At most SAMPLE_DOCUMENTS rows pass the window, and at most SAMPLE_BYTES of them reach the driver.
    so_far = F.sum(F.octet_length("features")).over(Window.orderBy("order", "features"))
    bags_of = sample.mapInArrow(_features, schema).where("features IS NOT NULL").orderBy("order", "features").limit(SAMPLE_DOCUMENTS)
    rows = bags_of.withColumn("so_far", so_far).where(F.col("so_far") <= SAMPLE_BYTES).orderBy("order", "features").collect()
    bags = [np.frombuffer(r.features, np.float32).reshape(-1, FEATURES) for r in rows]
    y = np.array([r.label for r in rows])
    if not len(y) or y.min() == y.max():
        return float(y[0]) if len(y) else 0.5
    heads = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
    return train(np.concatenate(bags).astype(np.float64), heads, y, totals.get(1, 0) / sum(totals.values()))


@lean
def _score(batches: Iterator[pa.RecordBatch], network: Broadcast) -> Iterator[pa.RecordBatch]:
    model = network.value
    for batch in (part for whole in batches for part in slices(whole, 1, 4 << 20)):
        if isinstance(model, float):
            scores = np.full(batch.num_rows, model)
        else:
            scores = model.score(*passages(batch.column(1)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])


def score(docs: DataFrame, network: Network | float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1, higher is better) of every whole text; null texts are scored as empty ones.

    Each row stands for itself: repeated rows and null ids give rows alike. Further columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(network)
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(partial(_score, network=sent), schema)


@lean
def _keep(batches: Iterator[pa.RecordBatch], network: Broadcast, text_at: int, least: float) -> Iterator[pa.RecordBatch]:
    model = network.value
    for batch in (part for whole in batches for part in slices(whole, text_at, 4 << 20)):
        if isinstance(model, float):
            stay = np.full(batch.num_rows, model >= least)
        else:
            stay = model.score(*passages(batch.column(text_at))) >= least
        yield batch.filter(pa.array(stay))


def keep(docs: DataFrame, network: Network | float, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The documents, all columns as they are, that score `least` or more; a constant score keeps all or none."""
    sent = docs.sparkSession.sparkContext.broadcast(network)
    return docs.mapInArrow(partial(_keep, network=sent, text_at=docs.columns.index(text_col), least=least), docs.schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document's label must not be learned from; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1
