"""Quality classifier learnt from positives and unlabelled text (non-negative PU risk)."""

from __future__ import annotations

import math
import operator
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, identity, map_texts, remaining
from .sampling import labelled_texts, unlabelled_texts

#: Texts a model is fitted on: at most so many trusted positives, and so many unlabelled ones.
MOST_POSITIVE, MOST_UNLABELLED = 10_000, 20_000
THRESHOLD = 0.3
#: Each share is seen at these scales, at which it levels off.
SCALES = (0.05, 0.3)
#: Steps of the descent, its rate, the weight of the penalty, and the least spread of a feature.
STEPS, RATE, PENALTY, LEAST_SPREAD = 400, 0.05, 1e-3, 0.05

_SIGNS = re.compile(rb"[!#$%&*+=@^_~|<>\\]{2,}")
_NO_UPPER = bytes(range(256)), UPPER.encode()
_NO_LETTER = bytes(range(256)), (UPPER + LOWER).encode()
_NO_DIGIT = bytes(range(256)), b"0123456789"
_NO_PUNCTUATION = bytes(range(256)), b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _without(data: bytes, table: tuple[bytes, bytes]) -> int:
    return len(data.translate(*table))


def features(data: bytes | None) -> list[float]:
    """What the look of a text tells: shares that hardly depend on its length or language."""
    data = data or b""
    words = data.split()
    n, size = max(1, len(words)), max(1, len(data))
    lines = [x for x in data.split(b"\n") if x.strip()]
    letters = len(data) - _without(data, _NO_LETTER)
    upper = len(data) - _without(data, _NO_UPPER)
    shares = [
        sum(map(operator.eq, words, words[1:])) / n,
        1 - math.log(1 + len(set(words))) / math.log(1 + n) if words else 0.0,
        len(_SIGNS.findall(data)) / n,
        upper / max(1, letters),
        (len(data) - _without(data, _NO_DIGIT)) / size,
        (len(data) - _without(data, _NO_PUNCTUATION)) / size,
        1 - len(set(lines)) / max(1, len(lines)),
        sum(len(x) == 1 and not x.isalnum() for x in words) / n,
        sum(len(x) > 40 for x in words) / n,
    ]
    return [math.tanh(x / scale) for x in shares for scale in SCALES] + [float(not words)]


@dataclass(frozen=True)
class PuModel:
    """A linear model over the features; its score is the chance of a positive."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def basis(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.basis(x) @ self.weights[:-1] + self.weights[-1]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -30, 30)))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among the unlabelled, by scores that part the two.

    Above any threshold the unlabelled hold at least prior * (share of positives
    above it); so the smallest quotient of the two shares bounds the prior from
    above, and meets it where a threshold cuts off all negatives. Thresholds
    leave enough of both, and each quotient is raised by its sampling error. So
    on small samples the estimate errs upward, and the model then lets as large a
    share of bad texts pass rather than reject good ones.
    """
    cuts = np.quantile(positive, np.linspace(0.02, 0.7, 35))
    above_p = np.array([(positive >= c).mean() for c in cuts])
    above_u = np.array([(unlabelled >= c).mean() for c in cuts])
    error = np.sqrt(above_u * (1 - above_u) / len(unlabelled)) + np.sqrt(above_p * (1 - above_p) / len(positive))
    return float(np.clip(((above_u + error) / above_p).min(), 0.05, 0.99))


def _risk(margin_p: np.ndarray, margin_u: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Gradients by margin of the non-negative unbiased risk with the logistic loss, and the risk.

    risk = prior E_p[loss(g)] + max(0, E_u[loss(-g)] - prior E_p[loss(-g)])

    Where the part of the negatives has fallen below zero, the model has begun
    to fit single unlabelled texts, and the step goes against that part alone.
    """
    to_p, to_u = (1 / (1 + np.exp(-np.clip(g, -30, 30))) for g in (margin_p, margin_u))
    negative = np.logaddexp(0, margin_u).mean() - prior * np.logaddexp(0, margin_p).mean()
    risk = prior * np.logaddexp(0, -margin_p).mean() + max(0.0, negative)
    of_u, of_p = to_u / len(to_u), -prior * to_p / len(to_p)
    if negative < 0:
        return -of_p, -of_u, risk
    return of_p + prior * (to_p - 1) / len(to_p), of_u, risk


def _descend(p: np.ndarray, u: np.ndarray, prior: float | None) -> np.ndarray:
    """Weights by Adam; without a prior, of a plain classifier that parts ``p`` from ``u``."""
    w, m, v = np.zeros(p.shape[1] + 1), 0.0, 0.0
    for step in range(1, STEPS + 1):
        margin_p, margin_u = p @ w[:-1] + w[-1], u @ w[:-1] + w[-1]
        if prior is None:
            by_p = (1 / (1 + np.exp(-np.clip(margin_p, -30, 30))) - 1) / len(p)
            by_u = 1 / (1 + np.exp(-np.clip(margin_u, -30, 30))) / len(u)
        else:
            by_p, by_u, _ = _risk(margin_p, margin_u, prior)
        slope = np.append(p.T @ by_p + u.T @ by_u, by_p.sum() + by_u.sum())
        slope[:-1] += PENALTY * w[:-1]
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> PuModel:
    """A model from the features of trusted positives and of unlabelled texts."""
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(axis=0), np.maximum(both.std(axis=0), LEAST_SPREAD)
    p, u = (positive - mean) / scale, (unlabelled - mean) / scale
    parting = _descend(p, u, None)
    prior = estimate_prior(p @ parting[:-1], u @ parting[:-1])
    return PuModel(mean, scale, _descend(p, u, prior), prior)


def _matrix(texts: DataFrame) -> np.ndarray:
    """Features of a bounded sample of texts."""
    found = map_texts(texts, [], F.col("text"), "x array<double>", lambda: lambda data: (features(data),)).toPandas()
    return np.array(found["x"].tolist(), float).reshape(-1, len(features(b"")))


def train_quality(
    docs: DataFrame,
    labels: DataFrame,
    learn,
    target: str = "quality",
    most_positive: int = MOST_POSITIVE,
    most_unlabelled: int = MOST_UNLABELLED,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> PuModel | None:
    """Learn what texts labelled 1 look like, from them and from texts without a label.

    ``learn`` (a function of the id column) says which documents may be learnt
    from. Labels of 0 are never used. Samples are bounded by the two parameters.
    Where no text is without a label, all that may be learnt from are taken as
    unlabelled. None if there are no positives or nothing to compare them with.
    """
    allowed = learn(F.col("key"))
    known = labels.where(F.col(target) == 1)
    positive = _matrix(labelled_texts(docs, known, target, allowed, most_positive, id_column, text_column).select("text"))
    unlabelled = _matrix(unlabelled_texts(docs, labels, allowed, most_unlabelled, id_column, text_column))
    if not len(unlabelled):
        unlabelled = _matrix(
            unlabelled_texts(docs, labels.limit(0), allowed, most_unlabelled, id_column, text_column)
        )
    if not len(positive) or not len(unlabelled):
        return None
    return fit(positive, unlabelled)


def score_quality(
    docs: DataFrame, model: PuModel | None, keep: list[str], text_column: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The columns ``keep`` with ``score`` (chance of quality 1) and ``predicted``, for every row.

    One narrow pass over whole texts; only the text counts. Null counts as the
    empty text, which is scored like any other. Without a model (nothing to
    learn from) every score is 0.5. Repeated rows are scored alike; an empty
    table gives no rows.
    """

    def start():
        def one(data: bytes | None) -> tuple[float, int]:
            score = float(model.score(np.array([features(data)]))[0]) if model else 0.5
            return score, int(score >= threshold)

        return one

    return map_texts(docs, keep, F.col(text_column), "score double, predicted int", start)


def keep_quality(docs: DataFrame, labels: DataFrame, learn, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is predicted to be of quality, all columns as they were."""
    model = train_quality(docs, labels, learn, id_column=id_column, text_column=text_column)
    told = docs.select(identity(id_column, text_column).alias("row"), F.col(text_column).alias("text"))
    decided = score_quality(told, model, ["row"], "text").select("row", (F.col("predicted") == 1).alias("kept"))
    return remaining(docs, decided, id_column, text_column)
