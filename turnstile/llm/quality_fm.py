"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)): all pairwise
interactions at a cost linear in the features of a text.  Trained by Adagrad in numpy on a
bounded sample of labelled rows (their hashed features, not their texts, go to the driver);
every text is scored whole, in Arrow batches.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BUCKETS = 1 << 14
BINS = 12
SYMBOLS = "#*$%&|<>"
#: upper ends of the bins of each structure statistic (shares of the words, but for the last four)
EDGES: dict[str, tuple[float, ...]] = {
    "symbols": (0.0, 0.02, 0.05, 0.1, 0.2, 0.4, 1.0, 2.0),
    "shouted": (0.0, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7),
    "stutter": (0.0, 0.01, 0.03, 0.06, 0.1, 0.2, 0.4),
    "distinct": (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9),
    "marks": (0.0, 0.02, 0.05, 0.1, 0.2, 0.5, 0.9),
    "digits": (0.0, 0.01, 0.05, 0.1, 0.3),
    "lines": (0.0, 0.01, 0.02, 0.04, 0.08, 0.2, 0.5),
    "mean_length": (2.0, 3.0, 4.0, 4.5, 5.0, 5.5, 6.0, 7.0, 9.0),
    "words": (0, 2, 5, 10, 30, 100, 300, 1000, 3000, 10000),
    "declared": (0, 10, 50, 100, 300, 1000, 3000, 10000, 30000),
}
SIZE = WORD_BUCKETS + BINS * len(EDGES)


def text_features(text: str | None, n_chars: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids and values of one text (None: empty); ``n_chars`` is the row's metadata (None: its own bin)."""
    text = text or ""
    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    stats = (
        sum(map(text.count, SYMBOLS)) / n, sum(map(str.isupper, words)) / n, sum(map(eq, words, words[1:])) / n,
        len(counts) / n, (text.count("!") + text.count("?")) / n, sum(map(text.count, "0123456789")) / n,
        text.count("\n") / n, sum(map(len, words)) / n, len(words))
    ids = [zlib.crc32(w.encode("utf-8", "replace")) % WORD_BUCKETS for w in counts]
    values = np.sqrt(np.fromiter(counts.values(), dtype=np.float32, count=len(counts)))
    values /= max(1.0, float(np.sqrt((values ** 2).sum())))
    where = [int(np.searchsorted(e, s)) for e, s in zip(EDGES.values(), stats)]
    known = n_chars is not None and n_chars == n_chars
    where.append(int(np.searchsorted(EDGES["declared"], n_chars)) if known else BINS - 1)
    ids += [WORD_BUCKETS + BINS * k + b for k, b in enumerate(where)]
    return np.array(ids, dtype=np.int32), np.concatenate([values, np.full(len(where), 0.5, dtype=np.float32)])


class FactorisationMachine:
    def __init__(self, rank: int = 8, rate: float = 0.1, l2: float = 1e-4, epochs: int = 8, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.rate, self.l2, self.epochs, self.seed = rate, l2, epochs, seed
        self.bias = 0.0
        self.w = np.zeros(SIZE, dtype=np.float32)
        self.v = rng.normal(0, 0.02, (SIZE, rank)).astype(np.float32)

    def logit(self, ids: np.ndarray, x: np.ndarray) -> float:
        vx = self.v[ids] * x[:, None]
        s = vx.sum(axis=0)
        return float(self.bias + self.w[ids] @ x + 0.5 * ((s * s).sum() - (vx * vx).sum()))

    def score(self, ids: np.ndarray, x: np.ndarray) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.logit(ids, x), -30, 30))))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> FactorisationMachine:
        """Rows in any order train alike up to rounding: they are shuffled by a fixed seed."""
        ones = sum(y for *_, y in rows)
        prior = (ones + 3) / (len(rows) + 4)  # no labels: above the threshold, nothing is rejected
        self.bias = float(np.log(prior / (1 - prior))) if prior < 1 else 30.0
        if not 0 < ones < len(rows):
            self.v[:] = 0  # one class only: the smoothed share is all there is to learn
            return self
        gw, gv, gb = np.full(SIZE, 1e-6), np.full(self.v.shape, 1e-6, dtype=np.float32), 1e-6
        rng = np.random.default_rng(self.seed)
        for _ in range(self.epochs):
            for k in rng.permutation(len(rows)):
                ids, x, y = rows[k]
                v = self.v[ids]
                vx = v * x[:, None]
                s = vx.sum(axis=0)
                z = self.bias + self.w[ids] @ x + 0.5 * ((s * s).sum() - (vx * vx).sum())
                g = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))) - y
                dw = g * x + self.l2 * self.w[ids]
                dv = g * x[:, None] * (s - vx) + self.l2 * v
                gw[ids] += dw * dw
                gv[ids] += dv * dv
                gb += g * g
                self.w[ids] -= self.rate * dw / np.sqrt(gw[ids])
                self.v[ids] -= self.rate * 0.3 * dv / np.sqrt(gv[ids])
                self.bias -= self.rate * g / np.sqrt(gb)
        return self


def held_out(doc_id: Column) -> Column:
    """The rows that training never sees; a null id is not held out and never has a label."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  chars_col: str | None = "n_chars", label_col: str = "quality", max_labelled: int = 4000) -> FactorisationMachine:
    """A model from at most ``max_labelled`` labelled rows that are not held out: those of lowest id hash (a
    bounded sample, documented; the rest of the work covers all rows).  Several labels of one id: the lowest;
    null labels are no labels; repeated documents of an id all train."""
    chosen = (labels.select(F.col(id_col).alias("__label_id"), F.col(label_col).cast("int").alias("__label"))
              .where(F.col("__label").isin(0, 1) & ~held_out(F.col("__label_id")) & F.col("__label_id").isNotNull())
              .groupBy("__label_id").agg(F.min("__label").alias("__label"))
              .orderBy(F.xxhash64("__label_id"), "__label_id").limit(max_labelled))
    chars = F.col(chars_col).cast("double") if chars_col and chars_col in docs.columns else F.lit(None).cast("double")
    rows = (docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"), chars.alias("chars"))
            .join(F.broadcast(chosen), F.col("__id") == F.col("__label_id"))  # max_labelled rows at most
            .select("__id", "text", "chars", "__label"))

    def features(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            got = [text_features(t, c) for t, c in zip(part["text"], part["chars"])]
            yield pd.DataFrame({"id": part["__id"].astype(str), "ids": [i.tobytes() for i, _ in got],
                                "x": [x.tobytes() for _, x in got], "y": part["__label"]})

    found = rows.mapInPandas(features, "id string, ids binary, x binary, y int").collect()
    found = sorted(found, key=lambda r: (r["id"], bytes(r["ids"])))
    return FactorisationMachine().fit([
        (np.frombuffer(bytes(r["ids"]), dtype=np.int32), np.frombuffer(bytes(r["x"]), dtype=np.float32), r["y"]) for r in found])


def quality_score(model: FactorisationMachine, text: Column, chars: Column) -> Column:
    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, declared in parts:
            yield pd.Series([model.score(*text_features(t, c)) for t, c in zip(texts, declared)], dtype="float64")

    return score(text, chars.cast("double"))


def with_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 chars_col: str = "n_chars", into: str = "score", **options) -> DataFrame:
    """``docs`` with the column ``into``: 0 to 1, higher where a quality label of 1 is likelier.

    Only the text and its declared length go into a score.  Null and empty texts get the score of a text
    without words; a missing or null declared length is a feature of its own.  Without usable labels
    every row gets 0.75, with labels of one class their smoothed share."""
    model = train_quality(docs, labels, id_col, text_col, chars_col, **options)
    chars = F.col(chars_col) if chars_col in docs.columns else F.lit(None)
    return docs.withColumn(into, quality_score(model, F.col(text_col), chars))
