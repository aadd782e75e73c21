"""Operator 7: quality classifier, a regularised quadratic discriminant over transformed document statistics."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import common

FEATURES = (
    "log_words", "mean_word", "sd_word", "upper", "digit", "symbol", "comma_stop", "bang", "newline",
    "repeat_word", "caps_word", "short_word",
)

_UP = np.zeros(256, bool)
_UP[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ",.;:"]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def statistics(text: str | None) -> np.ndarray:
    """The statistics of one whole text (None: empty), each transformed towards a bell shape; always finite."""
    text = text or ""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n = max(1, len(data))
    hist = np.bincount(data, minlength=256)
    words = text.split()
    m = len(words)
    out = np.zeros(len(FEATURES))
    out[0] = math.log1p(m)
    if m:
        lens = np.fromiter(map(len, words), np.int64, m)
        out[1], out[2] = math.log1p(lens.mean()), math.log1p(lens.std())
        out[9] = math.log(m / len(set(words))) / math.log1p(m)
        out[10] = math.sqrt(sum(map(str.isupper, words)) / m)
        out[11] = math.sqrt(float((lens <= 1).mean()))
    share = lambda mask: math.sqrt(float(hist[mask].sum()) / n)
    out[3], out[4], out[5], out[6] = share(_UP), share(_DIGIT), share(_SYMBOL), share(_STOP)
    out[7] = math.sqrt(hist[33] / n)
    out[8] = math.sqrt(hist[10] / n)
    return out


@dataclass
class Discriminant:
    """Class means, inverses of the Cholesky factors of the shrunk covariances, log-determinants and log-priors."""

    means: np.ndarray
    whiten: np.ndarray
    logdets: np.ndarray
    priors: np.ndarray
    single: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        """P(label 1) of rows x, from the difference of Mahalanobis log densities."""
        if self.single is not None:
            return np.full(len(x), self.single)
        logs = []
        for c in range(2):
            z = self.whiten[c] @ (x - self.means[c]).T
            logs.append(self.priors[c] - 0.5 * self.logdets[c] - 0.5 * (z * z).sum(axis=0))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def _blocks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for b in batches:
        yield b, np.array([statistics(t) for t in b.column(column).to_pylist()]).reshape(b.num_rows, len(FEATURES))


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", shrink: float = 0.1, ridge: float = 1e-4) -> Discriminant:
    """Fit on every document that has a label 0 or 1 in labels(doc_id, target).

    Only statistics, not texts, meet the labels in the join. They are summed in the tasks (counts, sums and cross products a class), so one small row a task and class meets
    in the final sums. Each class covariance is shrunk by `shrink` towards the pooled diagonal, plus `ridge`. A document
    labelled twice counts once a label; rows without doc_id have none; null texts count as empty. With one class only, or an
    empty table of labels or documents, the score is that class's label; with none it is 0.5.
    """
    d = len(FEATURES)
    known = labels.where(F.col(target).isin(0, 1)).select("doc_id", F.col(target).cast("int").alias("y")).distinct()

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x in _blocks(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "x"])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for b in batches:
            x, y = np.asarray(b.column(1).flatten()).reshape(b.num_rows, d), np.asarray(b.column(0))
            for c in range(2):
                own = x[y == c]
                total[c] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        yield pa.RecordBatch.from_pydict({"y": pa.array([0, 1], pa.int32()), "s": pa.array(list(total), pa.list_(pa.float64()))})

    kind = docs.schema["doc_id"].dataType.simpleString()
    stats = docs.select("doc_id", "text").mapInArrow(common.tidied(features), f"doc_id {kind}, x array<double>")
    part = stats.join(known, "doc_id").select("y", "x").mapInArrow(sums, "y int, s array<double>")
    flat = part.select("y", F.posexplode("s").alias("at", "v")).groupBy("y", "at").agg(F.sum("v").alias("v")).collect()
    total = np.zeros((2, 1 + d + d * d))
    for r in flat:
        total[r.y, r.at] = r.v
    return from_sums(total, shrink, ridge)


def from_sums(total: np.ndarray, shrink: float, ridge: float) -> Discriminant:
    d = len(FEATURES)
    n = total[:, 0]
    if (n < 1).any():
        return Discriminant(np.zeros((2, d)), np.zeros((2, d, d)), np.zeros(2), np.zeros(2), 0.5 if (n < 1).all() else float(n[1] > 0))
    means = total[:, 1 : d + 1] / n[:, None]
    cov = np.array([total[c, d + 1 :].reshape(d, d) / n[c] - np.outer(means[c], means[c]) for c in range(2)])
    pooled = np.diag((cov * n[:, None, None]).sum(axis=0).diagonal() / n.sum())
    cov = (1 - shrink) * cov + shrink * pooled + ridge * np.eye(d)
    factors = np.linalg.cholesky(cov)
    return Discriminant(means, np.linalg.inv(factors), 2 * np.log(np.diagonal(factors, axis1=1, axis2=2)).sum(axis=1), np.log(n / n.sum()))


def score(docs: DataFrame, model: Discriminant, text: str = "text", out: str = "score") -> DataFrame:
    """docs with a column `out` more: P(label 1) of each whole text.

    Null and empty texts get the score of a text without words; repeated rows get equal scores; an empty table gives an empty
    one. A column already named `out` is replaced. The model (a few kB whatever the input) travels with the task.
    """
    keep = [c for c in docs.columns if c != out]
    source = docs.select(*[F.col(f"`{c}`") for c in keep])
    schema = StructType([*source.schema.fields, StructField(out, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x in _blocks(batches, text):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.score(x))], [*b.schema.names, out])

    return source.mapInArrow(common.tidied(run), schema)
