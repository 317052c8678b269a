"""Quality classifier: a byte-level convolutional network in numpy.

Learned filters of ``WIDTH`` bytes slide over the whole UTF-8 text.  Their
responses are max-pooled over overlapping chunks (two halves each, moving by
one half), rectified, and combined over the document by mean, maximum and
minimum into one logistic probability.  Scoring reads a text block by block, so memory is
bounded for texts of any length.

Training uses at most ``SAMPLE`` labelled rows per class (the documented bound:
a hash-ordered sample, texts up to ``SAMPLE_BYTES`` bytes), never rows of the
held-out fold, and balances the classes.  Labels, language, source and id are
no inputs of a score.

Defined results: null and empty texts get the score of an empty text;
repeated rows are scored alike; without labels of both classes every score is
0.5; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 1500
SAMPLE_BYTES = 32768
FILTERS = 16
WIDTH = 8
STRIDE = 2
HALF = 256
BLOCK = 1 << 20
THRESHOLD = 0.7
HELD_OUT = 2
MINUS = np.float32(-1e9)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


class ByteCnn:
    """The network; ``taps[t, byte, filter]`` are the filters over one-hot bytes."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.taps = rng.normal(0, 0.2, (WIDTH, 256, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = rng.normal(0, 0.1, 3 * FILTERS).astype(np.float32)
        self.shift = np.zeros(1, np.float32)

    def params(self) -> list:
        return [self.taps, self.bias, self.out, self.shift]

    def halves(self, data: np.ndarray, lo: int, hi: int, argmax: bool = False):
        """Maximum response of each filter in each half chunk of data[lo:hi]."""
        n = max(1, -(-(hi - lo) // HALF))
        piece = np.zeros(n * HALF + WIDTH, np.uint8)
        own = data[lo:min(len(data), lo + n * HALF + WIDTH)]
        piece[:len(own)] = own
        positions = n * HALF // STRIDE
        conv = self.taps[0].take(piece[0:n * HALF:STRIDE], axis=0)
        for t in range(1, WIDTH):
            conv += self.taps[t].take(piece[t:t + n * HALF:STRIDE], axis=0)
        conv[max(1, -(-(hi - lo) // STRIDE)):positions] = MINUS
        conv = conv.reshape(n, HALF // STRIDE, FILTERS)
        if not argmax:
            return conv.max(axis=1)
        at = conv.argmax(axis=1)
        top = np.take_along_axis(conv, at[:, None, :], axis=1)[:, 0, :]
        return top, (at + (np.arange(n) * (HALF // STRIDE))[:, None]) * STRIDE, piece

    def logit(self, data: np.ndarray) -> float:
        """Score of a whole text, read in blocks."""
        tops = [self.halves(data, lo, min(len(data), lo + BLOCK)) for lo in range(0, max(1, len(data)), BLOCK)]
        act = np.maximum(_chunks(np.concatenate(tops)) + self.bias, 0)
        return float(_combined(act) @ self.out + self.shift[0])

    def gradient(self, data: np.ndarray, label: float, weight: float, grads: list) -> None:
        """Adds one document's gradient; it flows through the pooled maxima only."""
        top, at, piece = self.halves(data, 0, len(data), argmax=True)
        chunk = _chunks(top)
        if len(top) > 1:
            at = np.where(top[1:] > top[:-1], at[1:], at[:-1])
        act = np.maximum(chunk + self.bias, 0)
        combined = _combined(act)
        z = combined @ self.out + self.shift[0]
        err = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label)
        grads[2] += err * combined
        grads[3] += err
        d = np.tile(err * self.out[:FILTERS] / len(act), (len(act), 1))
        d[act.argmax(axis=0), np.arange(FILTERS)] += err * self.out[FILTERS:2 * FILTERS]
        d[act.argmin(axis=0), np.arange(FILTERS)] += err * self.out[2 * FILTERS:]
        d *= act > 0
        grads[1] += d.sum(axis=0)
        t = np.arange(WIDTH)[:, None, None]
        np.add.at(grads[0], (t, piece[at[None] + t], np.arange(FILTERS)[None, None]), d[None])

    def fit(self, texts: list, labels: list, epochs: int = 14, batch: int = 32, rate: float = 0.01,
            decay: float = 1e-4, seed: int = 3) -> "ByteCnn":
        """Adam on the class-balanced logistic loss."""
        labels = np.asarray(labels, np.float32)
        share = labels.mean()
        weights = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
        rng = np.random.default_rng(seed)
        first, second = ([np.zeros_like(p) for p in self.params()] for _ in range(2))
        step = 0
        # Small samples get more passes, so that the number of steps stays useful.
        epochs = max(epochs, min(40, int(np.ceil(600 * batch / len(texts)))))
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for lo in range(0, len(order), batch):
                rows = order[lo:lo + batch]
                grads = [np.zeros_like(p) for p in self.params()]
                for r in rows:
                    self.gradient(texts[r], float(labels[r]), float(weights[r]), grads)
                step += 1
                for p, g, m, v in zip(self.params(), grads, first, second):
                    g = g / len(rows) + decay * p
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        return self


def _chunks(halves: np.ndarray) -> np.ndarray:
    """Overlapping chunks: the maxima of neighbouring halves."""
    return halves if len(halves) == 1 else np.maximum(halves[1:], halves[:-1])


def _combined(act: np.ndarray) -> np.ndarray:
    """A document's chunks by mean, by the strongest and by the weakest."""
    return np.concatenate([act.mean(axis=0), act.max(axis=0), act.min(axis=0)])


def to_bytes(text) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality"):
    """A fitted network, or None without labelled rows of both classes."""
    # Labels of one document that disagree say nothing about it: it is left out.
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label"))
             .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("_most"))
             .filter("label = _most").select("doc_id", "label"))
    order = F.xxhash64("doc_id", F.lit("quality"))
    # At most 2 * sample ids, whatever the number of labels.
    picked = known.filter("label = 0").orderBy(order, "doc_id").limit(sample).unionAll(
        known.filter("label = 1").orderBy(order, "doc_id").limit(sample))
    rows = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= SAMPLE_BYTES)
            .join(F.broadcast(picked), "doc_id")
            # One text an id: of repeated ids the first by hash, then by text.
            .groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text")).collect())
    rows.sort(key=lambda r: (r.doc_id, r.text or ""))
    if len({r.label for r in rows}) < 2:
        return None
    model = ByteCnn().fit([to_bytes(r.text) for r in rows], [r.label for r in rows])
    # The loss is class-balanced; the score is the probability at the labels' own shares.
    ones, zeros = known.agg(F.count(F.when(F.col("label") == 1, 1)), F.count(F.when(F.col("label") == 0, 1))).first()
    model.shift += np.float32(np.log(ones / zeros))
    return model


def score(text: Column, model) -> Column:
    """Probability of label 1 as a column; the network travels with the task."""
    if model is None:
        return F.lit(0.5)

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        z = np.array([model.logit(to_bytes(t)) for t in texts], dtype=np.float64)
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return probability(text)


def classify(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted."""
    return (docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                        score(F.col(text_col), model).alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)))
