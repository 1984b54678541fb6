"""Quality scores by Bradley-Terry ranking of document pairs (operator 9).

Preference pairs are formed of labelled documents, one of label 1 over one of label 0. The score of
a document is linear in features of its text; its weights minimise the logistic loss of the score
differences over the pairs, with a ridge. A quantile of the learning rows' scores, the share of
label 0 among them, is the threshold: there the score that is returned, a logistic function of the
learned one, is 0.3.

A null text counts as empty. Features are of the text alone. Labels that are null teach nothing;
where a class is missing nothing is learned, and every score is 0.5. Repeated rows score alike;
columns are only added.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that are learned from at most, about; a hash of the id chooses them.
SAMPLE = 20_000
#: Pairs, about.
PAIRS = 60_000
CUT = 0.3
RIDGE = 1.0

_SIGNS = {ord(c): None for c in "!\"#$%&()*+/:;<=>?@[\\]^_`{|}~"}
_DIGITS = {ord(c): None for c in "0123456789"}


def features(text: str | None) -> list[float]:
    """Of the whole text; every entry is bounded or a logarithm."""
    t = text or ""
    n = len(t)
    words = t.split()
    m = len(words)
    if not m:
        return [0.0] * 16
    kinds = set(words)
    lines = [x for x in t.split("\n") if x.strip()]
    repeats = sum(map(str.__eq__, words, words[1:]))
    letters = sum(map(len, words))
    marks = t.count(".") + t.count("!") + t.count("?")
    upper = sum(map(str.isupper, words))
    alone = sum(1 for w in kinds if len(w) == 1)
    signs = n - len(t.translate(_SIGNS))
    ended = sum(x.rstrip()[-1] in ".!?" for x in lines)
    return [
        np.log1p(m),
        len(kinds) / m,
        len(kinds) / m**0.75,
        repeats / m,
        letters / m / 10,
        signs / n,
        np.log1p(100 * signs / m),
        upper / m,
        (n - len(t.translate(_DIGITS))) / n,
        t.count("!") / m,
        t.count("|") / m,
        marks / m,
        t.count(",") / m,
        len(set(lines)) / len(lines),
        ended / len(lines),
        alone / m,
    ]


def pairs(label: np.ndarray, n: int = PAIRS) -> tuple[np.ndarray, np.ndarray]:
    """(better, worse): each document of the rarer class meets as many of the other as fit in n, all of them in turn."""
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return good[:0], bad[:0]
    rng = np.random.default_rng(42)
    each = max(1, n // max(len(good), len(bad)))
    most = max(len(good), len(bad))
    turn = lambda ids: np.concatenate([np.resize(rng.permutation(ids), most) for _ in range(each)])
    return turn(good), turn(bad)


class Ranking:
    """Weights, and the line from learned scores to returned ones."""

    def __init__(self, x: np.ndarray, label: np.ndarray):
        self.weights = None
        better, worse = pairs(label)
        if not len(better):
            return
        self.middle, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = np.clip((x - self.middle) / self.scale, -6, 6)
        z = np.concatenate([z, z**2 - 1], axis=1)
        d = z[better] - z[worse]
        w = np.zeros(d.shape[1])
        for _ in range(30):  # Newton's method
            p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
            grad = d.T @ (p - 1) + RIDGE * w
            step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + RIDGE * np.eye(len(w)), grad)
            w -= step / max(1.0, np.abs(step).max() / 5)
            if np.abs(step).max() < 1e-6:
                break
        self.weights = w
        s = z @ w
        self.threshold = float(np.quantile(s, np.mean(label == 0)))
        self.slope = 2 / max(float(np.quantile(s, 0.9) - np.quantile(s, 0.1)), 1e-9)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        z = np.clip((x - self.middle) / self.scale, -6, 6)
        s = (np.concatenate([z, z**2 - 1], axis=1) @ self.weights - self.threshold) * self.slope
        return 1 / (1 + np.exp(-np.clip(s + np.log(CUT / (1 - CUT)), -30, 30)))


def feature_column(text: str) -> Column:
    @F.pandas_udf("array<double>")
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([features(t) for t in texts], dtype=object)

    return made(F.col(text))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ranking:
    """From documents (doc_id, text) and labels (doc_id, quality). At most about ``sample``
    labelled ids, a bound that allows them to be broadcast, pick their texts in one scan; of texts
    that share an id the one with the least features is learned from, of labels the larger."""
    known = labels.where("quality in (0, 1) and doc_id is not null").select("doc_id", "quality")
    n = known.count()
    if not n:
        return Ranking(np.zeros((0, 16)), np.zeros(0))
    chance = F.pmod(F.xxhash64(F.lit("pairs"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.where(chance < sample / n).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", feature_column("text").alias("x"))
    rows = sorted(rows.groupBy("doc_id").agg(F.max("quality").alias("quality"), F.min("x").alias("x")).collect(), key=lambda r: r["doc_id"])
    return Ranking(np.array([r["x"] for r in rows]).reshape(-1, 16), np.array([r["quality"] for r in rows]))


def score(ranking: Ranking, text: Column | str) -> Column:
    """The score of whole texts, 0 to 1."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(ranking.scores(np.array([features(t) for t in texts]).reshape(-1, 16)))

    return scored(F.col(text) if isinstance(text, str) else text)


def held_out() -> Column:
    """Rows whose crc32(doc_id as text) mod 5 is 0; a null id is none of them."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
