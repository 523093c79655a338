"""Toxicity scores from non-negative positive-unlabelled learning."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from meterfold.llm.common import or_empty, small_batches

_WORD = re.compile(r"[^\W\d_]+")
_PREFIXES = (4, 5, 6)
_MEMO_WORDS = 150_000


@dataclass(frozen=True)
class Settings:
    """Training parameters; the two sample sizes bound what reaches the driver."""

    max_toxic: int = 3_000
    max_unlabelled: int = 6_000
    least_evidence: float = 8.0
    models: int = 3
    steps: int = 400
    rate: float = 0.1
    decay: float = 3e-5
    threshold: float = 0.7
    seed: int = 11


def _word_features(word: str) -> tuple[int, ...]:
    """Hashes of the word itself and of its beginnings, which inflected forms share."""
    starts = [f"{n}:{word[:n]}" for n in _PREFIXES if len(word) > n]
    return tuple(xxhash.xxh3_64_intdigest(f.encode()) for f in (f"w:{word}", *starts))


def text_features(text: str | None) -> np.ndarray:
    """Distinct features of the whole text, sorted."""
    found = {f for w in set(_WORD.findall((text or "").lower())) for f in _word_features(w)}
    return np.array(sorted(found), dtype=np.uint64)


@dataclass(frozen=True)
class ToxicityModel:
    """Classifiers over the presence of features; their mean log-odds make the score."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def log_odds(self, texts) -> Iterator[float]:
        weight = dict(zip(self.features.tolist(), self.weights.tolist()))
        memo: dict[str, tuple[int, ...]] = {}
        for text in texts:
            if len(memo) > _MEMO_WORDS:
                memo.clear()
            active: set[int] = set()
            for word in set(_WORD.findall((text or "").lower())):
                known = memo.get(word)
                if known is None:
                    known = memo[word] = tuple(f for f in _word_features(word) if f in weight)
                if known:
                    active.update(known)
            yield self.bias + sum(weight[f] for f in sorted(active))

    def score(self, text: Column) -> Column:
        """Probability-like score in [0, 1] of a text column; an absent text counts as empty."""
        model = self

        @pandas_udf(T.DoubleType())
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                odds = np.fromiter(model.log_odds(batch), dtype=float, count=len(batch))
                yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(odds, -500, 500))))

        return scored(text)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


class _Sparse:
    """Binary rows of feature numbers, with the two products that training needs."""

    def __init__(self, rows: list[np.ndarray], width: int):
        self.n, self.width = len(rows), width
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])
        self.col = np.concatenate(rows) if rows else np.zeros(0, np.int64)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=weights[self.col], minlength=self.n)

    def transposed(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, weights=values[self.row], minlength=self.width)


def fit_nnpu(toxic: _Sparse, unlabelled: _Sparse, prior: float, s: Settings) -> tuple[np.ndarray, float]:
    """Logistic non-negative PU learning (Kiryo and others, 2017) with full-batch Adam.

    The risk of clean text is that of unlabelled text less ``prior`` times that of toxic text
    taken as clean. Where this estimate falls below zero the model has begun to memorise, and the
    step goes against that term instead.
    """
    width = toxic.width
    theta = np.zeros(width + 1)
    theta[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, s.steps + 1):
        w, b = theta[:-1], theta[-1]
        p, u = _sigmoid(toxic.times(w) + b), _sigmoid(unlabelled.times(w) + b)
        # loss of calling a text clean is -log(1 - p), of calling it toxic -log(p)
        clean_risk = -np.log1p(-np.minimum(u, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(p, 1 - 1e-12)).mean()
        pull = prior * (p - 1) / toxic.n
        push_u, push_p = u / unlabelled.n, -prior * p / toxic.n
        if clean_risk < 0:
            pull, push_u, push_p = np.zeros_like(pull), -push_u, -push_p
        on_toxic = pull + push_p
        gradient = np.append(
            toxic.transposed(on_toxic) + unlabelled.transposed(push_u) + s.decay * w, on_toxic.sum() + push_u.sum()
        )
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta -= s.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        # every feature was chosen as a sign of toxicity, so none may speak against it
        theta[:-1] = np.maximum(theta[:-1], 0)
    return theta[:-1], float(theta[-1])


def train(toxic: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, s: Settings = Settings()) -> ToxicityModel:
    """Classifiers on different halves of the unlabelled text, averaged.

    A feature takes part if it is in more toxic texts than unlabelled text lets expect, with an
    evidence c ln(c / e) - (c - e) (c texts where e are expected: the exponent of the bound on a
    Poisson tail) of at least ``least_evidence``. Without toxic or unlabelled text, or without such
    features, every text gets the score of the prior.
    """
    prior = min(max(prior, 1e-3), 0.5)
    constant = ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), float(np.log(prior / (1 - prior))))
    if not toxic or not unlabelled:
        return constant
    names, counts = np.unique(np.concatenate(toxic), return_counts=True)
    others = np.concatenate(unlabelled)
    places = np.searchsorted(names, others)
    known = names[np.minimum(places, len(names) - 1)] == others if len(names) else np.zeros(len(others), bool)
    elsewhere = np.bincount(places[known], minlength=len(names))
    expected = len(toxic) * (elsewhere + 0.5) / len(unlabelled)
    evidence = np.where(counts > expected, counts * np.log(counts / expected) - (counts - expected), 0)
    names = names[evidence >= s.least_evidence]
    if not len(names):
        return constant

    def numbered(rows: list[np.ndarray]) -> _Sparse:
        return _Sparse([np.searchsorted(names, r[np.isin(r, names, assume_unique=True)]) for r in rows], len(names))

    rng, fits = np.random.default_rng(s.seed), []
    positive = numbered(toxic)
    for _ in range(s.models):
        half = rng.permutation(len(unlabelled))[: max(1, (len(unlabelled) + 1) // 2)]
        fits.append(fit_nnpu(positive, numbered([unlabelled[i] for i in half]), prior, s))
    weights = np.mean([w for w, _ in fits], axis=0)
    strong = np.abs(weights) > 1e-3
    return ToxicityModel(names[strong], weights[strong], float(np.mean([b for _, b in fits])))


def held_out(doc_id: Column) -> Column:
    """Whether a row's label is kept from training, by the checksum of its id."""
    key = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(key.cast("binary")), F.lit(3)) == 1


@pandas_udf(T.ArrayType(T.LongType()))
def _features(texts: pd.Series) -> pd.Series:
    return pd.Series([text_features(t).astype(np.int64) for t in texts])


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> ToxicityModel:
    """Train on the labelled toxic texts and on unlabelled text, none of them held out.

    The class prior is the share of toxic ones among the labels. Of toxic and of unlabelled texts
    the sample in the order of a hash of the id is used, up to the sizes in ``s``.
    """
    open_labels = (
        labels.filter("doc_id is not null and toxic is not null")
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    share = open_labels.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0] or 0.0
    texts = small_batches(docs).select("doc_id", or_empty(F.col("text")).alias("text")).filter("doc_id is not null")

    def sample(ids: DataFrame, size: int) -> list[np.ndarray]:
        # ids are chosen before texts are read: at most `size` of them, so they may be broadcast
        chosen = ids.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
        rows = texts.join(F.broadcast(chosen), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
        arrow = rows.orderBy("doc_id").select(_features("text").alias("f")).toArrow()
        return [np.asarray(f.values.to_numpy(), dtype=np.int64).view(np.uint64) for f in arrow["f"]]

    toxic = sample(open_labels.filter("toxic = 1").select("doc_id"), s.max_toxic)
    unlabelled = sample(texts.filter(~held_out(F.col("doc_id"))).select("doc_id"), s.max_unlabelled)
    return train(toxic, unlabelled, share, s)


def score_documents(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs(doc_id, text)``.

    Edge cases: an absent text is the empty one, which has the score of the bias alone; a row
    without id is scored like any other; repeated rows get equal scores; several labels of one id
    count as toxic if one does; without usable labels every score is the prior's; an empty table
    gives no rows; columns other than ``doc_id``, ``text`` and ``labels.toxic`` are not read.
    """
    model = fit(docs, labels, s)
    return docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score(F.col("text")).alias("score")
    ).withColumn("predicted", (F.col("score") >= s.threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The rows whose whole text scores below the threshold, with all their columns.

    Edge cases: as in :func:`score_documents`; a row without id or text is judged like any other,
    repeated rows stay or go together, without usable labels (or toxic ones among them) every row
    stays, and an empty table gives no rows. Columns may have any names, those used here too.
    """
    model = fit(docs, labels, s)
    rows = docs.select(F.struct("*").alias("row"), model.score(F.col("text")).alias("score"))
    return rows.filter(F.col("score") < s.threshold).select("row.*")
