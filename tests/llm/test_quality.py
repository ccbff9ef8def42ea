import math
import random
import zlib

from pyspark.sql import functions as F

from contrail.llm import quality
from contrail.llm.common import table

from helpers import EDGE, SF_MID, clashing, docs, stored

LABELS = "doc_id bigint, quality int, toxic int"


def test_held_out_accuracy(spark):
    got = quality.score_quality(table(spark, SF_MID, "documents"), table(spark, SF_MID, "labels")).collect()
    truth = {r[0]: r[1] for r in stored("labels", SF_MID)}
    assert len(got) == len(stored("documents", SF_MID))
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    held = [(truth[r["doc_id"]], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 50 and sum(a == b for a, b in held) / len(held) > 0.97


def test_edge_rows(spark):
    labels = spark.createDataFrame([(1, 0, 0), (5, 1, 0), (5, None, 0), (None, 1, 0), (9, 1, 1)], LABELS)
    for frame in (docs(spark, EDGE), clashing(docs(spark, EDGE))):
        got = quality.score_quality(frame, labels).collect()
        assert len(got) == len(EDGE) and all(0 <= r["score"] <= 1 for r in got)
        assert [r["held_out"] for r in got if r["doc_id"] is None] == [False, False]
        assert quality.keep_quality(frame, labels).columns == frame.columns


def test_one_kind_of_label_rejects_nothing(spark):
    for rows in ([], [(1, 1, 0)]):
        got = quality.score_quality(docs(spark, EDGE), spark.createDataFrame(rows, LABELS)).collect()
        assert {(r["score"], r["predicted"]) for r in got} == {(0.5, 1)}
    assert quality.score_quality(docs(spark, []), spark.createDataFrame([], LABELS)).count() == 0


def test_pairs_order_the_better_first():
    import numpy as np
    x = np.array([[1.0, v] for v in range(20)])
    model = quality.fit_pairs(x, (x[:, 1] >= 12).astype(int))
    raw = ((x - model.mean) / model.scale) @ model.weights - model.cut
    assert ((raw >= 0) == (x[:, 1] >= 12)).all()


def labelled(n):
    """Ids that aren't held out, their texts and labels: repeated words are what label 0 has."""
    rng = random.Random(5)
    ids = [i for i in range(3 * n) if zlib.crc32(str(i).encode()) % 3 != 1][:n]
    rows = []
    for i in ids:
        bad = rng.random() < 0.35
        words = rng.choices(["a", "b"] if bad else [f"w{k}" for k in range(40)], k=rng.randint(1, 30))
        rows.append((i, " ".join(words), int(bad == (rng.random() < 0.1))))
    return rows


def test_every_labelled_row_is_learned_from(spark, monkeypatch):
    import numpy as np
    rows = labelled(700)
    monkeypatch.setattr(quality, "BLOCK", 64)
    table = docs(spark, [r[:2] for r in rows])
    for flip in (0, 1):  # either class is the larger one
        labels = spark.createDataFrame([(i, label ^ flip, 0) for i, _, label in rows], LABELS)
        order = [r[0] for r in labels.orderBy(F.xxhash64("doc_id"), "doc_id").select("doc_id").collect()]
        of = {i: (quality.features(t), label ^ flip) for i, t, label in rows}
        want = quality.fit_pairs(np.array([of[i][0] for i in order]), np.array([of[i][1] for i in order]))
        got = quality.fit(table, labels)
        for one, other in ((got.mean, want.mean), (got.scale, want.scale), (got.weights, want.weights), (got.cut, want.cut)):
            assert np.allclose(one, other, rtol=1e-6, atol=1e-6)


def test_no_label_beyond_9000_is_left_out(spark):
    n = 9500
    ids = [i for i in range(3 * n) if zlib.crc32(str(i).encode()) % 3 != 1][:n]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in ids], LABELS)
    table = spark.createDataFrame([(i, "x" * (i % 5 + 1) + " y" * (i % 2)) for i in ids], "doc_id bigint, text string")
    feats = quality.fit(table, labels)
    assert abs(feats.mean[3] - sum(math.log1p(i % 5 + 1 + 2 * (i % 2)) for i in ids) / n) < 1e-9
