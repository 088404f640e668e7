"""Feature and routing jobs against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickweave.operators import features as ft, interests as it, samples as sm, scoring as sc
from clickweave.operators.gather import GATHER_VALUES
from clickweave.plans import recall_job
from tests.conftest import rows

DIM, LENGTH, VOCAB = 3, 6, 12


@pytest.fixture(scope="module")
def table():
    x = np.random.default_rng(1).normal(size=(VOCAB, DIM))
    x[0] = 0.0
    return x


@pytest.fixture(scope="module")
def emb(spark, table):
    return spark.createDataFrame(
        [("item_id", i, [float(a) for a in v]) for i, v in enumerate(table)],
        "embedding_name string, idx bigint, vec array<double>")


@pytest.fixture(scope="module")
def data():
    """Histories, one of them empty and one longer than the padded length."""
    rnd = np.random.default_rng(2)
    out = []
    for r, n in enumerate([0, 1, 3, 6, 9, 4, 5]):
        hist = [int(a) for a in rnd.integers(1, VOCAB, size=min(n, LENGTH))]
        out.append((r, hist + [0] * (LENGTH - len(hist)), n,
                    [float(w) for w in rnd.integers(0, 8, size=LENGTH) / 8], int(rnd.integers(1, VOCAB))))
    return out


@pytest.fixture(scope="module")
def samples(spark, data):
    return spark.createDataFrame(data, "row_id bigint, hist_item_id array<int>, hist_len int, "
                                       "w array<float>, item_id int").repartition(3)


def history(combiner="mean", weight=None, norm=True, length="hist_len"):
    ids = ft.SparseFeature("hist_item_id", VOCAB, DIM, embedding_name="item_id")
    return ft.SequenceFeature(ids, LENGTH, combiner, length, weight, norm)


def vectors(df, col="hist_item_id_vec"):
    return {r["row_id"]: np.array(r[col]) for r in df.collect()}


@pytest.mark.parametrize("combiner", ["sum", "mean", "max"])
@pytest.mark.parametrize("weight", [None, "w"])
@pytest.mark.parametrize("norm", [True, False])
@pytest.mark.parametrize("small_values", [GATHER_VALUES, 0])
def test_pooling(samples, emb, table, data, combiner, weight, norm, small_values):
    got = vectors(ft.pool_feature(samples, emb, history(combiner, weight, norm),
                                  small_values=small_values))
    for r, ids, n, w, _ in data:
        used = min(n, LENGTH)
        e = table[ids[:used]]
        if weight:
            f = np.array(w[:used])
            f = np.exp(f) / np.exp(f).sum() if norm else f
            e = e * f[:, None]
        if combiner == "max":
            want = e.max(0) if used else np.full(DIM, -1e9)
        else:
            want = e.sum(0) if used else np.zeros(DIM)
            want = want / (n + 1e-8) if combiner == "mean" else want
        np.testing.assert_allclose(got[r], want, rtol=1e-9, atol=1e-12)


@pytest.mark.parametrize("small_values", [GATHER_VALUES, 0])
def test_pooling_without_a_length_counts_real_ids(samples, emb, table, data, small_values):
    got = vectors(ft.pool_feature(samples, emb, history("mean", length=None),
                                  small_values=small_values))
    for r, ids, n, _, _ in data:
        used = min(n, LENGTH)
        want = table[ids[:used]].sum(0) / (used + 1e-8) if used else np.zeros(DIM)
        np.testing.assert_allclose(got[r], want, atol=1e-12)


def test_lookup_of_hot_ids(samples, emb):
    plain = rows(ft.lookup(samples, emb, ft.SparseFeature("item_id", VOCAB, DIM)))
    assert rows(ft.lookup(samples, emb, ft.SparseFeature("item_id", VOCAB, DIM), hot_rows=1)) == plain


def squash(z):
    n = (z * z).sum(-1, keepdims=True)
    return n / (1 + n) / np.sqrt(n + 1e-8) * z


def numpy_routing(data, table, logits, bilinear, iterations):
    b = logits.copy()
    for _ in range(iterations):
        delta, caps = np.zeros_like(b), {}
        for r, ids, n, _, _ in data:
            mapped = table[ids] @ bilinear
            masked = np.where(np.arange(LENGTH) < n, b, -2.0 ** 32 + 1)
            w = np.exp(masked - masked.max(1, keepdims=True))
            w /= w.sum(1, keepdims=True)
            caps[r] = squash(w @ mapped)
            delta += caps[r] @ mapped.T
        b = b + delta
    return caps, b


@pytest.mark.parametrize("iterations", [1, 3])
@pytest.mark.parametrize("gathered", [True, False])
def test_routing(samples, emb, table, data, iterations, gathered):
    rnd = np.random.default_rng(8)
    logits, bilinear = rnd.normal(size=(4, LENGTH)), rnd.normal(size=(DIM, 2))
    small = ft.small_table(emb, history()) if gathered else None
    sequences = recall_job.history_sequences(samples, emb, history(), table=small)
    caps, b = it.route_interests(sequences, logits, bilinear, iterations, final_logits=True,
                                 table=small)
    want, want_b = numpy_routing(data, table, logits, bilinear, iterations)
    np.testing.assert_allclose(b, want_b, atol=1e-9)
    got = {r["row_id"]: np.array(r["capsules"]) for r in caps.collect()}
    for r, ids, n, _, _ in data:
        np.testing.assert_allclose(got[r], want[r] if n else np.zeros((4, 2)), atol=1e-9)
    assert sorted(got) == [d[0] for d in data]


def test_label_attention(spark):
    rnd = np.random.default_rng(6)
    caps, q = rnd.normal(size=(4, DIM)), rnd.normal(size=DIM)
    df = spark.createDataFrame([(caps.tolist(), q.tolist())],
                               "c array<array<double>>, q array<double>")
    for k_user, power in ((4, 1.0), (2, 2.0)):
        got = df.select(it.label_attention(F.col("c"), F.col("q"), power, F.lit(k_user))).first()[0]
        w = (caps @ q) ** power
        w = np.where(np.arange(4) < k_user, w, -2.0 ** 32 + 1)
        w = np.exp(w - w.max())
        np.testing.assert_allclose(got, (w / w.sum()) @ caps, atol=1e-12)
    fixed = df.select(it.label_attention(F.col("c"), F.col("q"))).first()[0]
    w = np.exp(caps @ q)
    np.testing.assert_allclose(fixed, (w / w.sum()) @ caps, atol=1e-12)


def test_sampled_softmax(samples, emb, table):
    rowset = samples.select("row_id", "item_id").withColumn("user_vec", F.array(
        F.lit(0.5), F.lit(-1.0), F.lit(2.0)))
    items = emb.where("idx > 0").select(F.col("idx").alias("item_id"), "vec")
    got = it.sampled_softmax(rowset, items, VOCAB, samples=200)
    logits = table @ np.array([0.5, -1.0, 2.0])
    own = {r["row_id"]: r["item_id"] for r in rowset.collect()}
    for r in got.collect():
        # With many draws every class is met about as often, the true one once.
        others = np.exp(np.delete(logits, [0, own[r["row_id"]]])).mean() * 200 * 10 / 11
        want = np.log(np.exp(logits[own[r["row_id"]]]) + others) - logits[own[r["row_id"]]]
        assert abs(r["loss"] - want) < 0.35


def test_dense_layers_and_norm(spark):
    rnd = np.random.default_rng(7)
    x = rnd.normal(size=(50, 4))
    norm = sc.Norm(rnd.normal(size=3), rnd.uniform(1, 2, 3), rnd.normal(size=3), rnd.normal(size=3))
    layers = [sc.Layer(rnd.normal(size=(4, 3)), rnd.normal(size=3), "relu", norm),
              sc.Layer(rnd.normal(size=(3, 2)), rnd.normal(size=2), "linear")]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i int, vec array<double>")
    want = x @ layers[0].weight + layers[0].bias
    want = (want - norm.mean) / np.sqrt(norm.variance + 1e-3) * norm.gamma + norm.beta
    want = np.maximum(want, 0) @ layers[1].weight + layers[1].bias
    got = sc.dense_layers(df.repartition(3), layers).orderBy("i").collect()
    np.testing.assert_allclose([r["vec"] for r in got], want, atol=1e-12)


def test_feature_rules(samples):
    with pytest.raises(TypeError):
        ft.feature_schema(["uid"])
    with pytest.raises(ValueError):
        ft.route_features([history()], [])
    spec = [history(), ft.DenseFeature("w", 5), ft.SparseFeature("item_id", 4)]
    bad = {r["feature"]: r["n_rows"] for r in ft.feature_violations(samples, spec).collect()}
    assert bad["hist_item_id"] == 0 and bad["w"] == 7
    assert bad["item_id"] == samples.where("item_id >= 4").count()


def test_embedding_tables_are_shared_and_padded(spark):
    spec = [ft.SparseFeature("item_id", VOCAB, DIM), history(), ft.SparseFeature("user_id", 5, 2)]
    got = ft.embedding_tables(spark, spec).collect()
    assert len(got) == VOCAB + 5
    assert all(set(r["vec"]) == {0.0} for r in got if r["idx"] == 0)
    again = ft.embedding_tables(spark, spec).repartition(7).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)


def test_learned_vectors_find_the_group(spark):
    """Two groups of users click two groups of items; the factors must tell them apart."""
    rnd = np.random.default_rng(11)
    data = [(u, 1 + int(rnd.integers(0, 10)) + 10 * (u % 2)) for u in range(1, 41) for _ in range(8)]
    clicks = spark.createDataFrame(data, "user_id bigint, item_id bigint")
    model = it.learn_vectors(clicks, rank=4, iterations=5)
    vecs = {r["idx"]: np.array(r["vec"]) for r in it.item_vectors(model).collect()}
    users = {r["id"]: np.array(r["features"]) for r in model.userFactors.collect()}
    right = sum(((max(vecs, key=lambda i: vecs[i] @ users[u]) - 1) // 10) == u % 2 for u in users)
    assert right >= 0.9 * len(users)


def test_user_vectors_to_candidates(samples, emb, spark):
    rnd = np.random.default_rng(12)
    layers = [sc.Layer(rnd.normal(size=(DIM, DIM)), np.zeros(DIM), "linear")]
    users = recall_job.user_vectors(samples, emb, [], history(),
                                    rnd.normal(size=(4, LENGTH)), rnd.normal(size=(DIM, DIM)), layers)
    assert rows(users.groupBy("row_id").count()) == [(r, 4) for r in range(7)]
    items = emb.where("idx > 0").select(F.col("idx").alias("item_id"), "vec")
    found = recall_job.recall(users, items, 3)
    assert rows(found.groupBy("user_id").count()) == [(r, 3) for r in range(7)]


def test_validation_split_is_complete_and_disjoint(spark):
    df = spark.range(2000).select((F.col("id") % 50).alias("user_id"), F.col("id").alias("pos"))
    inside = df.where(sm.in_validation(0.5)).count()
    assert df.where(~sm.in_validation(0.5)).count() == 2000 - inside
    assert 850 < inside < 1150
