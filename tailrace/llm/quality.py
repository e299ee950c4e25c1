"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text are all there is to learn from. With the share ``prior`` of positives
in the unlabelled text, the risk of a scorer is

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)),

whose second term, the risk on the unseen negatives, is kept from turning negative (the non-negative unbiased
risk). The prior is estimated first: a plain scorer of positives against unlabelled text ranks held-back
rows, and over all thresholds the smallest ratio of the two shares above it bounds the positives' share.

Features are read from the whole text: shares of byte pairs (hashed), of kinds of characters, of repeated words
and lines, of words equal to the one before, and of symbols that stand alone. Training uses a bounded sample of rows (``sample_rows`` of each kind, those whose
hashed id comes first); every row is scored.
"""

from __future__ import annotations

from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tailrace.llm.tables import slices
from tailrace.llm.words import scramble, utf8

_PAIRS = 512
_STEP = 1 << 20
_EXTRA = 8
SIZE = _PAIRS + _EXTRA


def _kinds() -> np.ndarray:
    """Kind of each byte: 0 lower case or beyond ASCII, 1 upper case, 2 digit, 3 white space, 4 the rest."""
    kind = np.zeros(256, np.int64)
    kind[:128] = 4
    kind[97:123], kind[65:91], kind[48:58] = 0, 1, 2
    kind[[9, 10, 11, 12, 13, 32]] = 3
    return kind


def features(text: np.ndarray) -> np.ndarray:
    """Features of one text, given as bytes; all zero for an empty one."""
    out = np.zeros(SIZE, np.float32)
    if not text.size:
        return out
    pair = _pair_buckets()
    counts, kinds, alone = np.zeros(_PAIRS), np.zeros(5), 0
    for a in range(0, text.size, _STEP):
        x = text[a : a + _STEP + 1].astype(np.int64)  # one byte of the next step closes the last pair
        counts += np.bincount(pair[x[:-1] << 8 | x[1:]], minlength=_PAIRS)
        k = _kinds()[x]
        kinds += np.bincount(k[: min(_STEP, text.size - a)], minlength=5)
        alone += np.count_nonzero((k[1:-1] == 4) & (k[:-2] == 3) & (k[2:] == 3))
    out[:_PAIRS] = np.sqrt(counts / max(counts.sum(), 1))
    out[_PAIRS : _PAIRS + 3] = np.sqrt(kinds[[1, 2, 4]] / text.size)
    raw = text.tobytes()
    words, lines = raw.split(), raw.split(b"\n")
    out[_PAIRS + 3] = 1 - len(set(words)) / max(len(words), 1)
    out[_PAIRS + 4] = 1 - len(set(lines)) / len(lines)
    out[_PAIRS + 6] = np.sqrt(sum(map(eq, words, islice(words, 1, None))) / max(len(words), 1))
    out[_PAIRS + 7] = np.sqrt(alone / max(len(words), 1))
    out[_PAIRS + 5] = np.log1p(text.size) / 10
    return out


def _pair_buckets() -> np.ndarray:
    global _buckets
    if _buckets is None:
        _buckets = (scramble(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(_PAIRS)).astype(np.int64)
    return _buckets


_buckets: np.ndarray | None = None


def _matrix(column: pa.Array) -> np.ndarray:
    data, at = utf8(column)
    return np.stack([features(data[a:b]) for a, b in zip(at[:-1], at[1:])])


def _sampled(docs: DataFrame, ids: DataFrame) -> np.ndarray:
    """Feature rows of the documents with the given ids, in the order of ids; of rows that repeat an id, the one with
    the smallest text. ``ids`` has a bounded number of rows, so the result has too."""

    def run(batches):
        for batch in slices(batches, "text"):
            rows = _matrix(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), SIZE).cast(pa.list_(pa.float32()))], ["doc_id", "x"]
            )

    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    table = rows.mapInArrow(run, "doc_id bigint, x array<float>").toArrow().sort_by("doc_id")
    return np.array(table.column("x").combine_chunks().flatten()).reshape(-1, SIZE) if table.num_rows else np.zeros((0, SIZE), np.float32)


def _first(ids: DataFrame, n: int) -> DataFrame:
    return ids.where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Model:
    """A linear scorer over standardised features with a logistic link."""

    def __init__(self, positives: np.ndarray, unlabelled: np.ndarray):
        both = np.vstack((positives, unlabelled)).astype(np.float64)
        self.mean = both.mean(axis=0) if len(both) else np.zeros(SIZE)
        self.scale = np.maximum(both.std(axis=0), 1e-3) if len(both) else np.ones(SIZE)
        self.w, self.b = np.zeros(SIZE), 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.w + self.b

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.margin(x))

    def fit(self, positives: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 400, decay: float = 1e-3, negative_risk: bool = True) -> Model:
        """Adam on the non-negative risk; without ``negative_risk``, unlabelled rows simply count as negatives."""
        p = np.clip((positives - self.mean) / self.scale, -8, 8)
        u = np.clip((unlabelled - self.mean) / self.scale, -8, 8)
        m, v = np.zeros(SIZE + 1), np.zeros(SIZE + 1)
        for step in range(1, steps + 1):
            sp, su = _sigmoid(p @ self.w + self.b), _sigmoid(u @ self.w + self.b)
            good = -(1 - sp) / len(p)  # slope of the logistic loss of positives as positives
            bad_p, bad_u = sp / len(p), su / len(u)  # and of both as negatives
            if not negative_risk:
                gp, gu = good, bad_u
            elif -np.log1p(-np.minimum(su, 1 - 1e-12)).mean() - prior * -np.log1p(-np.minimum(sp, 1 - 1e-12)).mean() >= 0:
                gp, gu = prior * good - prior * bad_p, bad_u
            else:  # the negatives' risk went below zero: step back from it
                gp, gu = prior * bad_p, -bad_u
            g = np.concatenate((gp @ p + gu @ u + decay * self.w, [gp.sum() + gu.sum()]))
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            move = 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            self.w, self.b = self.w - move[:-1], self.b - move[-1]
        return self


def class_prior(positives: np.ndarray, unlabelled: np.ndarray, least_share: float = 0.2) -> float:
    """Share of positives among the unlabelled rows, from the scores of both on rows not trained on.

    For each threshold with at least ``least_share`` of the positives above it, the share of unlabelled rows
    above it over that of the positives is at least the prior, up to chance, for which one standard error is added.
    """
    t = np.unique(np.quantile(positives, np.linspace(0, 1 - least_share, 200)))
    above_p = 1 - np.searchsorted(np.sort(positives), t) / len(positives)
    above_u = 1 - np.searchsorted(np.sort(unlabelled), t) / len(unlabelled)
    noise = np.sqrt(above_u * (1 - above_u) / len(unlabelled) + above_p * (1 - above_p) / len(positives))
    best = np.argmin((above_u + noise) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def train(docs: DataFrame, positives: DataFrame, unlabelled: DataFrame, sample_rows: int = 6000) -> tuple[Model, float]:
    """The model and the estimated prior. ``positives`` and ``unlabelled`` are tables of doc_id.

    Without positives or without unlabelled rows there is nothing to learn: all scores are then 0.5.
    """
    p, u = _sampled(docs, _first(positives.select("doc_id"), sample_rows)), _sampled(docs, _first(unlabelled.select("doc_id"), sample_rows))
    model = Model(p, u)
    if len(p) < 4 or len(u) < 4:
        return model, 0.5
    plain = Model(p[::2], u[::2]).fit(p[::2], u[::2], 0.5, negative_risk=False)
    prior = class_prior(plain.score(p[1::2]), plain.score(u[1::2]))
    return model.fit(p, u, prior), prior


def scored(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The columns of ``docs`` with score (0 to 1) and predicted (1 from ``threshold`` on) in place of any such columns.

    A null text is an empty one, and both get the score of no features. Equal texts have equal scores.
    """
    docs = docs.select([F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("score", "predicted")])

    def run(batches):
        for batch in slices(batches, "text"):
            score = model.score(_matrix(batch.column("text")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))], [*batch.schema.names, "score", "predicted"])

    schema = StructType([*docs.schema, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return docs.mapInArrow(run, schema)
