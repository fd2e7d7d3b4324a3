"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts (P) and unlabelled texts (U) train linear classifiers in
numpy by the non-negative PU risk

    prior * mean_P[l(f)] + max(0, mean_U[l(-f)] - prior * mean_P[l(-f)])

with the logistic loss l; where the second term would fall below zero the step
goes the other way for it, so the classifier cannot profit from fitting U.
The prior is the toxic share of the labelled training rows; labels of other
rows are not used.

A text's features are its distinct words and their first 4, 5 and 6
characters, hashed.  Each classifier keeps the features that are surer in P
than in U.  The sample is dealt into a few bags, one classifier is trained in
a task for each, and their mean is broadcast (a few thousand weights).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter.functions.pyworker import ship_by_value
from sifter.llm.common import materialize, only
from sifter.llm.tokens import byte_table, groups, real_words

MAX_POSITIVE = 8_000  # rows of P in the training sample (by hash of doc_id; all, if there are fewer)
MAX_UNLABELLED = 24_000  # rows of U in the training sample
BAG_POSITIVE = 1_000  # a further bag for each so many rows of P
MAX_BAGS = 4
FEATURE_BITS = 22
MAX_FEATURES = 2_048
MIN_Z = 4.0
PREFIXES = (4, 5, 6)
STEPS = 400
RATE = 0.1
RIDGE = 1e-4
HELD_OUT_FOLDS = 5
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def held_out(doc_id: Column, folds: int = HELD_OUT_FOLDS) -> Column:
    """Whether a document's label must not be learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def word_features(word: str) -> list[int]:
    """Hashed features of one word: itself and its beginnings."""
    word = word.lower()
    parts = [word, *(f"{word[:k]}*" for k in PREFIXES if len(word) >= k)]
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) & (1 << FEATURE_BITS) - 1 for p in parts]


def features_of(texts: pa.Array, weights: dict[int, float] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) pairs, each once; only features with a weight if those are given."""
    counts, words = real_words(texts, byte_table(SEPARATORS))
    coded = pc.dictionary_encode(words)
    lists = [word_features(w) for w in coded.dictionary.to_numpy(zero_copy_only=False).tolist()]
    if weights is not None:
        lists = [[f for f in fs if f in weights] for fs in lists]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.fromiter((f for fs in lists for f in fs), np.int64, int(sizes.sum()))
    which = coded.indices.to_numpy(zero_copy_only=False)
    text = np.repeat(np.arange(len(counts)), counts)
    some = sizes[which] > 0
    which, text = which[some], text[some]
    if not len(which):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.unique(text * len(lists) + which)  # a word once per text
    text, which = pairs // len(lists), pairs % len(lists)
    n = sizes[which]
    ends = np.cumsum(n)
    feature = flat[np.repeat((np.cumsum(sizes) - sizes)[which] - (ends - n), n) + np.arange(int(ends[-1]))]
    pairs = np.unique(np.repeat(text, n) << FEATURE_BITS | feature)
    return pairs >> FEATURE_BITS, pairs & (1 << FEATURE_BITS) - 1


# --- the classifier -----------------------------------------------------------------

def select_features(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """Features that are surer in P than in U: two-proportion z of at least MIN_Z, the surest first."""
    def share(rows: list[np.ndarray]) -> np.ndarray:
        return np.bincount(np.concatenate(rows), minlength=1 << FEATURE_BITS) if rows else np.zeros(1 << FEATURE_BITS)

    n_p, n_u = len(positive), len(unlabelled)
    in_p, in_u = share(positive), share(unlabelled)
    some = np.flatnonzero(in_p >= 2)
    both = (in_p[some] + in_u[some]) / (n_p + n_u)
    z = (in_p[some] / n_p - in_u[some] / max(n_u, 1)) / np.sqrt(
        np.maximum(both * (1 - both), 1e-12) * (1 / n_p + 1 / max(n_u, 1)))
    order = np.lexsort((some, -z))
    order = order[z[order] >= MIN_Z][:MAX_FEATURES]
    return some[order]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def train_nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> tuple[np.ndarray, np.ndarray, float]:
    """(features, weights, bias) of the linear classifier with the least non-negative PU risk (Adam, whole sample)."""
    keep = select_features(positive, unlabelled) if positive else np.zeros(0, np.int64)
    bias = float(np.log(prior / (1 - prior)))
    if not len(keep) or not unlabelled:
        return keep[:0], np.zeros(0), bias
    place = np.full(1 << FEATURE_BITS, -1)
    place[keep] = np.arange(len(keep))

    def matrix(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        col = place[np.concatenate(rows)]
        return row[col >= 0], col[col >= 0]

    (row_p, col_p), (row_u, col_u) = matrix(positive), matrix(unlabelled)
    n_p, n_u, k = len(positive), len(unlabelled), len(keep)
    theta, m, v = np.append(np.zeros(k), bias), np.zeros(k + 1), np.zeros(k + 1)
    for step in range(1, STEPS + 1):
        f_p = np.bincount(row_p, weights=theta[col_p], minlength=n_p) + theta[k]
        f_u = np.bincount(row_u, weights=theta[col_u], minlength=n_u) + theta[k]
        negative = np.logaddexp(0, f_u).mean() - prior * np.logaddexp(0, f_p).mean()
        g_u, g_n = sigmoid(f_u) / n_u, -prior * sigmoid(f_p) / n_p  # of the second term
        if negative >= 0:
            g_p = -prior * sigmoid(-f_p) / n_p + g_n
        else:
            g_u, g_p = -g_u, -g_n
        grad = np.append(np.bincount(col_u, weights=g_u[row_u], minlength=k) + np.bincount(col_p, weights=g_p[row_p], minlength=k)
                         + RIDGE * theta[:k], g_u.sum() + g_p.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return keep, theta[:k], float(theta[k])


def _sampled(rows: DataFrame, total: int, most: int) -> DataFrame:
    """Rows by hash of doc_id, ``most`` of them as far as the hash is even."""
    if total <= most:
        return rows
    return rows.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < int((1 << 30) * most / total))


def train(docs: DataFrame, labels: DataFrame, folds: int = HELD_OUT_FOLDS) -> tuple[dict[int, float], float]:
    """(weight by feature, bias): the mean of the bags' classifiers.

    ``labels``: (doc_id, toxic); rows with other than 0 or 1 and held-out rows
    are ignored, a document labelled both ways is toxic.  Without a confirmed
    toxic row the classifier has only its bias.
    """
    texts = only(docs, "doc_id", "text").filter(~held_out(F.col("doc_id"), folds) & F.col("text").isNotNull())
    known = (only(labels, "doc_id", "toxic").filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"), folds))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n_known, n_toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    prior = min(max((n_toxic + 0.5) / (n_known + 1.0), 1e-4), 0.5) if n_known else 0.05
    if not n_toxic:
        return {}, float(np.log(prior / (1 - prior)))
    bags = int(min(MAX_BAGS, max(1, min(n_toxic, MAX_POSITIVE) // BAG_POSITIVE)))
    toxic = _sampled(known.filter("toxic = 1").select("doc_id"), n_toxic, MAX_POSITIVE)
    # at most about MAX_POSITIVE ids, whatever the input: broadcast, so no text is shuffled to find them
    sample = (texts.join(F.broadcast(toxic), "doc_id", "left_semi").withColumn("positive", F.lit(True))
              .unionByName(_sampled(texts, texts.select("doc_id").count(), MAX_UNLABELLED).withColumn("positive", F.lit(False)))
              .select("text", "positive", F.pmod(F.xxhash64("doc_id"), F.lit(bags)).cast("int").alias("bag")))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, group in groups(batch.column(0), 2_000_000):
                text, feature = features_of(group)
                cuts = np.searchsorted(text, np.arange(len(group) + 1))
                rows = [feature[a:b].astype("<i4").tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows, pa.binary()), batch.column(1).slice(first, len(group)), batch.column(2).slice(first, len(group))],
                    ["features", "positive", "bag"])

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        split = {kind: [np.frombuffer(f, "<i4").astype(np.int64) for f in some["features"]]
                 for kind, some in rows.groupby("positive")}
        keep, weights, bias = train_nnpu(split.get(True, []), split.get(False, []), prior)
        return pd.DataFrame({"feature": np.append(keep, -1), "weight": np.append(weights, bias)})

    extracted = materialize(sample.mapInArrow(extract, "features binary, positive boolean, bag int"), "toxic-sample")
    rows = extracted.groupBy("bag").applyInPandas(fit, "feature long, weight double").groupBy("feature").agg(
        F.sum("weight").alias("weight")).toPandas()  # at most MAX_FEATURES a bag
    weights = {int(f): float(w) / bags for f, w in zip(rows["feature"], rows["weight"])}
    bias = weights.pop(-1, float(np.log(prior / (1 - prior))))  # the prior's, when no sampled row has a text
    return weights, bias


def text_scores(group: pa.Array, weights: dict[int, float], bias: float) -> np.ndarray:
    """Probability of toxic of each text; NULL and empty texts have the bias alone."""
    text, feature = features_of(group, weights)
    return sigmoid(bias + np.bincount(text, weights=[weights[f] for f in feature.tolist()], minlength=len(group)))


def score(docs: DataFrame, model: tuple[dict[int, float], float]) -> DataFrame:
    """doc_id and score (probability of toxic) of every whole text; NULL and empty texts have the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    texts = only(docs, "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, group in groups(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(group)), pa.array(text_scores(group, *shared.value))], ["doc_id", "score"])

    return texts.mapInArrow(run, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame, folds: int = HELD_OUT_FOLDS) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from 0.5 up) of every document of ``docs`` (doc_id, text).

    Scores come from texts alone.  Repeated rows get the same score each, an
    empty table no rows.  Training runs when this is called.
    """
    return score(docs, train(docs, labels, folds)).select(
        "doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def remove_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, with all their columns.

    Each row is judged by its own text, whatever its doc_id, where it is read: no text is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, group in groups(batch.column(at)):
                yield batch.slice(first, len(group)).filter(pa.array(text_scores(group, *shared.value) < threshold))

    return docs.mapInArrow(keep, docs.schema)


ship_by_value(__name__)
