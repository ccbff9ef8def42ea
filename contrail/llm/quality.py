"""Quality classifier by Bradley-Terry pairwise ranking.

Every document gets a score ``w . x`` over text-only features ``x``.  ``w`` is
learned from preference pairs (a document labelled 1 is preferred to one
labelled 0): logistic loss on the feature difference, with a small ridge
term, solved by Newton steps.  A quantile of the scores of the labelled fit
rows then gives the cut: as large a share of them lies below it as is
labelled 0.  The reported score is ``sigmoid(w . x - cut)``, so 0.5 is the cut.

The fit takes every labelled row that isn't held out, each of the larger class
with ``partners`` opponents.  Feature vectors are written once in blocks of
``BLOCK`` rows with their opponents; a Newton step is one pass over the blocks, of which only
sums over the features reach the driver.  Scoring covers every row and whole
texts, with the model (a few dozen numbers) inside the function.

Defined cases: a null text is the empty text and is scored; label rows with a
null id or null quality are ignored; repeated label rows of an id count once
(the lowest label holds); repeated document rows are scored one by one; with
no labels of both kinds every score is 0.5 (nothing is rejected).
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm.common import keyed
from contrail.operators.ranking import in_ranges, running_totals
from contrail.session import cut_lineage

#: Rows of the larger class in a block of the fit.
BLOCK = 128
#: Symbols counted one by one (all printable ASCII that is not a letter or digit).
SYMBOLS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
DIGITS = "0123456789"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def features(text: str) -> list[float]:
    """Text-only features; every entry is finite for every text."""
    words = text.split()
    n, chars = max(len(words), 1), max(len(text), 1)
    lines = text.split("\n")
    kinds = len(set(words))
    repeats = sum(map(operator.eq, words, islice(words, 1, None)))
    symbols = [text.count(s) / n for s in SYMBOLS]
    return [
        1.0, float(not words), float(len(words) < 5), np.log1p(len(text)), np.log1p(len(words)),
        sum(map(len, words)) / n, kinds / n, np.log1p(kinds) / np.log1p(n), repeats / n,
        1 - len(set(lines)) / len(lines), np.log1p(chars / len(lines)), len(lines) / n,
        sum(map(text.count, DIGITS)) / chars, sum(map(text.count, CAPITALS)) / n,
        sum(symbols), max(symbols), *np.sqrt(symbols),
    ]


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def scores(self, texts) -> np.ndarray:
        """0 to 1; 0.5 and more is accepted."""
        x = np.array([features(t) for t in texts], dtype=float).reshape(len(texts), -1)
        return self.of_features(x)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights - self.cut

    def of_features(self, x: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(x), 0.5)
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -500, 500)))


EMPTY = Model(np.zeros(0), np.ones(0), np.zeros(0), 0.0)


def pair_sums(w: np.ndarray, diff: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian of the logistic loss, summed over the pairs' feature differences."""
    p = 1 / (1 + np.exp(np.clip(diff @ w, -500, 500)))
    return -diff.T @ p, (diff * (p * (1 - p))[:, None]).T @ diff


def newton(sums: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], size: int, pairs: int,
           ridge: float = 1e-3, steps: int = 25) -> np.ndarray:
    """The weights that minimise mean loss and ridge term; ``sums`` as ``pair_sums`` over all ``pairs``."""
    w, eye = np.zeros(size), np.eye(size)
    for _ in range(steps):
        grad, hess = sums(w)
        step = np.linalg.solve(ridge * eye + hess / pairs, ridge * w + grad / pairs)
        w -= step * min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def _centred(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / scale, -10, 10)


def fit_pairs(x: np.ndarray, label: np.ndarray, partners: int = 8, ridge: float = 1e-3, steps: int = 25) -> Model:
    """Bradley-Terry weights from pairs (label 1 over label 0), then the cut, of rows in memory.

    The rows come in an order that has nothing to do with their content, so
    that pairing row i of the larger class with rows i, i+1, ... of the other
    (cyclic) is a fair choice of opponents."""
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return EMPTY
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1.0
    z = _centred(x, mean, scale)
    rows = np.arange(max(len(good), len(bad)))
    diff = np.concatenate([z[good[rows % len(good)]] - z[bad[(rows + k) % len(bad)]] for k in range(partners)])
    w = newton(lambda w: pair_sums(w, diff), z.shape[1], len(diff), ridge, steps)
    ranked = np.sort(((x - mean) / scale) @ w)
    cut = len(bad)  # the quantile: as many fit rows lie below it as are labelled 0
    return Model(mean, scale, w, float((ranked[cut - 1] + ranked[cut]) / 2))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _features(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: [float(v) for v in features(t)])


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the ids whose labels are never learned from; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _labelled(feats: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, label, x of every id that is labelled and not held out, written once."""
    rows = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("label"))
            .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out())
            .groupBy("doc_id").agg(F.min("label").alias("label")))
    return cut_lineage(feats.join(rows, "doc_id").groupBy("doc_id").agg(F.min("label").alias("label"), F.min("x").alias("x")))


def _blocks(rows: DataFrame, n_good: int, n_bad: int, partners: int, mean: np.ndarray, scale: np.ndarray) -> DataFrame:
    """z of the rows in blocks: pair (r, k) is good row r against bad row r + k, both cyclic; a block has the pairs of BLOCK neighbours r."""
    n = max(n_good, n_bad)
    order = ["label", "_h", "doc_id"]
    ranked = running_totals(in_ranges(rows.withColumn("_h", F.xxhash64("doc_id")), order), ["label"], F.col("_bkt"), order[1:])
    good = F.col("label") == 1
    last = F.when(good, F.lit(n - 1)).otherwise(F.lit(n + partners - 2)).cast("bigint")
    placed = ranked.withColumn("first", F.col("rank") - 1).filter(F.col("first") <= last).select("label", "x", F.explode(
        F.sequence("first", last, F.when(good, F.lit(n_good)).otherwise(F.lit(n_bad)).cast("bigint"))).alias("at"))
    before = F.when(good, F.lit(0)).otherwise(F.lit(partners - 1))  # a bad row meets the good ones of as many places before it, too
    placed = placed.select("label", "x", "at", F.explode(F.sequence(
        F.floor(F.greatest(F.col("at") - before, F.lit(0)) / BLOCK),
        F.least(F.floor(F.col("at") / BLOCK), F.lit((n - 1) // BLOCK)))).alias("block"))

    def block(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("at")
        z = _centred(np.stack(part["x"]), mean, scale)
        one = (part["label"] == 1).to_numpy()
        return pd.DataFrame({"good": [z[one].tobytes()], "bad": [z[~one].tobytes()]})

    return cut_lineage(placed.groupBy("block").applyInPandas(block, "good binary, bad binary"))


def _block_sums(blocks: DataFrame, size: int, partners: int) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """``pair_sums`` over all blocks: one pass, and one row a task to the driver."""
    def sums(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            grad, hess = np.zeros(size), np.zeros((size, size))
            for batch in batches:
                for good, bad in zip(batch["good"], batch["bad"]):
                    good, bad = (np.frombuffer(b).reshape(-1, size) for b in (good, bad))
                    g, h = pair_sums(w, np.concatenate([good - bad[k:k + len(good)] for k in range(partners)]))
                    grad, hess = grad + g, hess + h
            yield pd.DataFrame({"sums": [np.r_[grad, hess.ravel()]]})
        total = np.sum([r["sums"] for r in blocks.mapInPandas(run, "sums array<double>").collect()], axis=0)
        return total[:size], total[size:].reshape(size, size)
    return sums


def fit_features(feats: DataFrame, labels: DataFrame, partners: int = 8) -> Model:
    """As ``fit_pairs``, from all labelled rows of (doc_id, x) that aren't held out, in
    the order of their ids' hashes."""
    rows = _labelled(feats, labels)
    count = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(count) < 2:
        return EMPTY
    seen = rows.agg(Summarizer.metrics("mean", "variance", "count").summary(array_to_vector("x")).alias("s")).first()["s"]
    n = seen["count"]
    mean, scale = seen["mean"].toArray(), np.sqrt(seen["variance"].toArray() * ((n - 1) / n))
    scale[scale < 1e-9] = 1.0
    blocks = _blocks(rows, count[1], count[0], partners, mean, scale)
    w = newton(_block_sums(blocks, len(mean), partners), len(mean), max(count.values()) * partners)
    raw = Model(mean, scale, w, 0.0).raw

    @F.pandas_udf(T.DoubleType())
    def scored(x: pd.Series) -> pd.Series:
        return pd.Series(raw(np.stack(x)) if len(x) else [], dtype=float)

    ranges = in_ranges(rows.select("doc_id", scored("x").alias("raw")), ["raw", "doc_id"])
    ranked = running_totals(ranges, [], F.col("_bkt"), ["raw", "doc_id"])
    ends = ranked.filter(F.col("rank").isin(count[0], count[0] + 1)).select("raw").collect()
    return Model(mean, scale, w, float(sum(r["raw"] for r in ends) / 2))


def fit(docs: DataFrame, labels: DataFrame, partners: int = 8) -> Model:
    """Fit on every labelled row that isn't held out."""
    rows = keyed(docs).filter(F.col("doc_id").isNotNull() & ~held_out())
    return fit_features(rows.select("doc_id", _features("text").alias("x")), labels, partners)


def scorer(model: Model):
    """``model`` as a column function over a text column."""
    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts.tolist()))
    return score


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    feats = cut_lineage(keyed(docs).select("doc_id", _features("text").alias("x")))
    model = fit_features(feats, labels)

    @F.pandas_udf(T.DoubleType())
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.of_features(np.stack(x)) if len(x) else [], dtype=float)

    return (feats.select("doc_id", held_out().alias("held_out"), score("x").alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def keep_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, all columns unchanged."""
    score = scorer(fit(docs, labels))
    return docs.filter(score(F.coalesce(F.col("text"), F.lit(""))) >= 0.5)
