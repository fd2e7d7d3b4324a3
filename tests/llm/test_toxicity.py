import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sifter.llm import toxicity as tx


def corpus(n=600, seed=0):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = ["w%d" % rng.randint(0, 400) for _ in range(rng.randint(20, 60))]
        toxic = i % 8 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randint(0, len(words)), rng.choice(["Idiot", "scum,", "lowei%d" % rng.randint(0, 99)]))
        docs.append((i, " ".join(words)))
        if i % 2 == 0 or i % 3 == 0:
            labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_documents_are_told_apart(spark):
    docs, labels = corpus()
    got = tx.classify(spark.createDataFrame(docs, "doc_id long, text string"),
                      spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.5)
    wrong = [r.doc_id for r in got if r.held_out and r.predicted != (r.doc_id % 8 == 0)]
    assert len(wrong) <= 2


def test_real_labels(spark, mid):
    df, _ = mid
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [r for r in tx.classify(df, labels).collect() if r.doc_id in truth and r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in rows]) > 0.9


def test_held_out_labels_are_not_learned_from(spark):
    docs, labels = corpus(300)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    a, b = ({r.doc_id: r.score for r in tx.classify(df, spark.createDataFrame(some, "doc_id long, toxic int")).collect()}
            for some in (labels, flipped))
    assert a == b


def test_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(9, 1), (9, 0), (5, 0), (7, None), (None, 1), (4, 7)], "doc_id long, toxic int")
    got = tx.classify(edge_docs, labels).collect()
    assert len(got) == 10 and all(0 <= r.score <= 1 for r in got)
    assert tx.classify(no_docs, labels).count() == 0
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in tx.classify(edge_docs, none).collect()} == {0}
    kept = tx.remove_toxic(edge_docs, none)
    assert kept.columns == edge_docs.columns and kept.count() == 10


def test_features_are_words_and_their_beginnings_once():
    text, feature = tx.features_of(pa.array(["Vequx vequx, a", "", "VEQUX"], pa.string()))
    assert sorted(feature[text == 0]) == sorted({*tx.word_features("vequx"), *tx.word_features("a")})
    assert set(text) == {0, 2}


def test_the_negative_part_of_the_risk_does_not_fall_below_zero():
    """Unlabelled data that holds the positives: they must not be learned as negatives."""
    rng = np.random.default_rng(0)
    signal = tx.word_features("scum")[0]
    p = [np.array([signal, *rng.integers(0, 1000, 5)]) for _ in range(60)]
    u = [np.array([signal, *rng.integers(0, 1000, 5)]) for _ in range(40)] + [rng.integers(0, 1000, 6) for _ in range(360)]
    keep, w, b = tx.train_nnpu(p, u, 0.1)
    assert signal in keep and w[list(keep).index(signal)] + b > 0 > b


def plain_nnpu(positive, unlabelled, keep, prior):
    """The same descent on the risk as written down, over dense rows and with gradients by differences."""
    x_p, x_u = (np.array([np.isin(keep, r) for r in rows], float) for rows in (positive, unlabelled))

    def losses(theta):
        f_p, f_u = x_p @ theta[:-1] + theta[-1], x_u @ theta[:-1] + theta[-1]
        negative = np.mean(np.log1p(np.exp(f_u))) - prior * np.mean(np.log1p(np.exp(f_p)))
        return prior * np.mean(np.log1p(np.exp(-f_p))), negative, tx.RIDGE / 2 * np.sum(theta[:-1] ** 2)

    theta = np.append(np.zeros(len(keep)), np.log(prior / (1 - prior)))
    m, v, below = np.zeros_like(theta), np.zeros_like(theta), 0
    for step in range(1, tx.STEPS + 1):
        back = losses(theta)[1] < 0  # then only its own part steps, the other way
        below += back

        def goal(t):
            first, negative, ridge = losses(t)
            return (-negative if back else first + negative) + ridge

        grad = np.array([(goal(theta + e) - goal(theta - e)) / 2e-6 for e in np.eye(len(theta)) * 1e-6])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta = theta - tx.RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return theta[:-1], theta[-1], below


def test_training_descends_the_risk_as_written_down(monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(tx, "STEPS", 60)
    for prior, share in ((0.05, 0.6), (0.4, 0.02)):
        p = [rng.choice(12, 8, replace=False) for _ in range(60)]
        u = [rng.choice(12, 4, replace=False) if rng.random() < share else 12 + rng.choice(40, 4, replace=False) for _ in range(300)]
        keep, w, b = tx.train_nnpu(p, u, prior)
        want_w, want_b, below = plain_nnpu(p, u, keep, prior)
        assert len(keep) >= 10 and np.abs(w - want_w).max() < 1e-3 and abs(b - want_b) < 1e-3
        assert 0 < below < tx.STEPS  # both kinds of step are taken


def test_one_bag_is_the_classifier_of_all_its_rows(spark):
    """Below the sample's bounds the trained weights and every score are those of plain training on all rows."""
    docs, labels = corpus(300)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    learn = {i for i, _ in docs if zlib.crc32(str(i).encode()) % 5}
    known = {i: y for i, y in labels if i in learn}
    rows = {i: np.unique([f for w in t.replace(",", " ").split() for f in tx.word_features(w)]) for i, t in docs}
    prior = (sum(known.values()) + 0.5) / (len(known) + 1.0)
    keep, w, b = tx.train_nnpu([rows[i] for i, y in known.items() if y], [rows[i] for i in learn], prior)
    weight = dict(zip(keep.tolist(), w))
    for r in tx.classify(df, lab).collect():
        f = b + sum(weight.get(x, 0.0) for x in rows[r.doc_id].tolist())
        assert abs(r.score - 1 / (1 + np.exp(-f))) < 1e-6


def test_rows_are_judged_by_their_own_text(spark):
    docs, labels = corpus(300)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    scores = {r.doc_id: r.score for r in tx.classify(df, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    texts = dict(docs)
    bad, good = max(scores, key=scores.get), min(scores, key=scores.get)
    assert scores[bad] >= 0.5 > scores[good]
    more = df.withColumn("row", F.lit(0)).unionByName(spark.createDataFrame(
        [(None, texts[bad], 1), (None, texts[good], 2), (-5, texts[bad], 3), (-5, texts[good], 4)], "doc_id long, text string, row int"))
    kept = tx.remove_toxic(more, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.row for r in kept.collect() if r.row) == [2, 4]
