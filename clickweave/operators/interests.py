"""Several interest vectors per user: routing, attention, sampled softmax, factors."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from clickweave.functions.arrays import dot, let, log2_floor_1p
from clickweave.functions.hashing import portable_hash
from clickweave.operators.blockscore import list_column, matrix, nested_lists
from clickweave.operators.gather import GATHER_VALUES, INDEX, Table, score_lists, table_of
from clickweave.operators.skew import HOT_ROWS, skew_join
from clickweave.session import ensure_checkpoint_dir, materialize, ship_package

MASKED = -2.0 ** 32 + 1
SQUASH_EPS = 1e-8
STEP_ROWS = 2_000


def interest_count(hist_len: Column, k_max: int) -> Column:
    """How many interests a history of that length supports: 1 .. k_max."""
    return F.greatest(F.lit(1), F.least(F.lit(k_max), log2_floor_1p(hist_len))).cast("int")


# --- routing ----------------------------------------------------------------

def sequence_rows(vectors: DataFrame, row_id: str = "row_id") -> DataFrame:
    """(row_id, places, values): the vectors of a row laid end to end, by position.

    A row holds at most the padded length of positions, so the lists are bounded.
    """
    entry = F.struct("pos", "vec")
    ordered = vectors.groupBy(row_id).agg(F.array_sort(F.collect_list(entry)).alias("_s"))
    return ordered.select(
        row_id, F.transform("_s", lambda e: e["pos"]).alias("places"),
        F.flatten(F.transform("_s", lambda e: e["vec"].cast("array<double>"))).alias("values"))


def _weights(logits: np.ndarray) -> np.ndarray:
    """The softmax of the logits over the first n positions, for n = 0 .. length.

    Rows share the logits, so the weights of a row depend on its number of positions alone.
    """
    length = logits.shape[1]
    used = np.arange(length)[None, :] < np.arange(length + 1)[:, None]
    weight = np.where(used[:, None, :], logits[None, :, :], MASKED)
    weight = np.exp(weight - weight.max(axis=2, keepdims=True))
    return weight / weight.sum(axis=2, keepdims=True)


def _histories(batch: pa.RecordBatch, length: int, dim: int, table: Table | None
               ) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """(rows, n, vectors (positions, rows, dim)) of a batch, for rows of equally many positions n.

    Vectors reach as far as the last counted position of these rows.
    """
    places = batch.column("places")
    sizes = places.value_lengths().to_numpy()
    row, at = np.repeat(np.arange(batch.num_rows), sizes), places.flatten().to_numpy()
    if table is None:
        source = np.vstack([batch.column("values").flatten().to_numpy().reshape(-1, dim),
                            np.zeros((1, dim))])
        number, none, take = np.arange(len(row)), len(row), source.__getitem__
    else:
        number = table.places(batch.column("index").flatten().to_numpy())
        none, take = table.none, table.take
    slots = np.full((batch.num_rows, length), none)
    slots[row, at] = number
    last = np.zeros(batch.num_rows, np.int64)
    np.maximum.at(last, row, at + 1)
    n = np.clip(batch.column("hist_len").to_numpy(), 0, length)
    order = np.argsort(n, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(n[order])) + 1):
        if not len(rows):
            continue
        wide = int(last[rows].max())
        yield rows, int(n[rows[0]]), take(slots[rows, :wide].T.reshape(-1)).reshape(wide, len(rows), dim)


def _capsules(weight: np.ndarray, vectors: np.ndarray, bilinear: np.ndarray) -> np.ndarray:
    """Capsules (k, rows, dim) of histories (positions, rows, dim) before the bilinear map."""
    wide, n, dim = vectors.shape
    pooled = weight[:, :wide] @ vectors.reshape(wide, n * dim)
    z = pooled.reshape(-1, dim) @ bilinear  # the map is linear: once a capsule, not a position
    norm = (z * z).sum(axis=1, keepdims=True)
    z *= norm / (1.0 + norm) / np.sqrt(norm + SQUASH_EPS)
    return z.reshape(len(weight), n, -1)


def route_interests(sequences: DataFrame, logits: np.ndarray, bilinear: np.ndarray,
                    iterations: int = 3, row_id: str = "row_id", final_logits: bool = False,
                    table: Table | None = None, keep: Sequence[str] = (),
                    late: Callable[[DataFrame], DataFrame] | None = None
                    ) -> tuple[DataFrame, np.ndarray]:
    """(row_id, hist_len, [keep,] capsules ARRAY<ARRAY<DOUBLE>>) and the routing logits.

    The logits are those the capsules were made with; ``final_logits`` adds the
    last iteration's change, which takes one more pass.

    ``sequences`` holds (row_id, hist_len, places, values), or, with a ``table`` of vectors
    that every task reads, (row_id, hist_len, places, index): then rows carry ids, not
    vectors, and these are looked up in each pass. The logits, one per
    capsule and position, are shared by all rows: every iteration is one pass in
    which each task sums its own changes, and only that k x length table is
    brought together. The input is written once, so no pass repeats what made it.
    ``late`` makes the rows of the last pass of the written ones: what it adds is not written.
    """
    ship_package(sequences.sparkSession)
    logits = np.array(logits, dtype=np.float64)
    bilinear = np.array(bilinear, dtype=np.float64)
    k, length = logits.shape
    dim = bilinear.shape[0]
    payload = "values" if table is None else "index"
    stored = materialize(sequences.select(row_id, F.col("hist_len").cast("int").alias("hist_len"),
                                          *keep, "places", payload), "sequences")
    shared = stored.sparkSession.sparkContext.broadcast(table)

    def changes(now: np.ndarray) -> np.ndarray:
        weight = _weights(now)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((k, length))
            for batch in batches:
                for part in parts_of(batch):
                    for rows, n, vectors in _histories(part, length, dim, shared.value):
                        wide, values = len(vectors), len(rows) * dim
                        back = _capsules(weight[n], vectors, bilinear) @ bilinear.T
                        total[:, :wide] += back.reshape(k, values) @ vectors.reshape(wide, values).T
            cap, pos = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cap.reshape(-1)), pa.array(pos.reshape(-1)), pa.array(total.reshape(-1))],
                names=["capsule", "pos", "change"])

        needed = stored.select("hist_len", "places", payload)
        parts = needed.mapInArrow(scan, "capsule bigint, pos bigint, change double")
        out = np.zeros((k, length))
        for r in parts.groupBy("capsule", "pos").agg(F.sum("change").alias("s")).collect():
            out[r["capsule"], r["pos"]] = r["s"]
        return out

    for _ in range(iterations - 1):
        logits = logits + changes(logits)
    last, weight = logits, _weights(logits)
    asked = stored if late is None else late(stored)
    carried = [c for c in asked.columns if c not in ("places", payload)]
    schema = T.StructType([*[asked.schema[c] for c in carried],
                           T.StructField("capsules", T.ArrayType(T.ArrayType(T.DoubleType())))])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts_of(batch):
                capsules = np.zeros((part.num_rows, k, bilinear.shape[1]))
                for rows, n, vectors in _histories(part, length, dim, shared.value):
                    capsules[rows] = _capsules(weight[n], vectors, bilinear).transpose(1, 0, 2)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in carried], nested_lists(capsules)],
                    names=[*carried, "capsules"])

    return asked.mapInArrow(emit, schema), last + changes(last) if final_logits else last


def parts_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of at most STEP_ROWS rows: a row takes up to length x dim values in memory."""
    for start in range(0, batch.num_rows, STEP_ROWS):
        yield batch.slice(start, STEP_ROWS)


def interest_rows(capsules: DataFrame, col: str = "capsules", row_id: str = "row_id") -> DataFrame:
    """(row_id, interest_no, vec): one row per interest vector."""
    return capsules.select(row_id, F.posexplode(col).alias("interest_no", "vec"))


# --- attention --------------------------------------------------------------

def label_attention(capsules: Column, query: Column, power: float = 1.0,
                    k_user: Column | None = None) -> Column:
    """Capsules weighted by a softmax of their powered product with the target vector.

    With ``k_user`` only the first so many capsules of a row take part.
    """
    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def attend(lists: pa.Array, asked: pa.Array, used: pa.Array) -> pa.Array:
        if len(lists) == 0:
            return pa.array([], pa.list_(pa.float64()))
        q = matrix(asked)
        c = matrix(lists.flatten()).reshape(len(lists), -1, q.shape[1])
        raw = np.einsum("rkd,rd->rk", c, q) ** float(power)
        if used.null_count == 0:
            places = np.arange(c.shape[1])[None, :]
            raw = np.where(places < used.to_numpy()[:, None], raw, MASKED)
        e = np.exp(raw - raw.max(axis=1, keepdims=True))
        return list_column(np.einsum("rk,rkd->rd", e / e.sum(axis=1, keepdims=True), c))

    ship_package(SparkSession.active())
    return attend(capsules, query.cast("array<double>"),
                  F.lit(None).cast("int") if k_user is None else k_user.cast("int"))


def tile_user_features(capsules: DataFrame, users: DataFrame | None = None,
                       other: str = "other_vec", row_id: str = "row_id") -> DataFrame:
    """Each capsule with the user's other features in front of it.

    Without ``users`` the capsules carry these features already.
    """
    both = capsules if users is None else capsules.join(users.select(row_id, other), row_id)
    wide = F.transform("capsules", lambda c: F.concat(F.col(other), c))
    return both.withColumn("capsules", wide).drop(other)


# --- sampled softmax --------------------------------------------------------

UNIFORM, LOG_UNIFORM = "uniform", "log_uniform"


def _draw(text: Column, classes: int, distribution: str) -> Column:
    """A class of 1 .. classes from a hash. Log-uniform: class c has the probability
    ln(1 + 1 / c) / ln(1 + classes), so small codes are drawn most."""
    if distribution == UNIFORM:
        return F.pmod(portable_hash(text), F.lit(classes)) + F.lit(1)
    u = portable_hash(text) / F.lit(4294967296.0)
    return F.least(F.floor(F.exp(u * F.log(F.lit(classes + 1.0)))), F.lit(classes)).cast("bigint")


def _log_expected(item: Column, classes: int, samples: int, distribution: str) -> Column:
    """Logarithm of how often a class is expected among the samples."""
    if distribution == UNIFORM:
        return F.lit(0.0)
    chance = F.log(F.lit(1.0) + F.lit(1.0) / item) / F.log(F.lit(classes + 1.0))
    return F.log(F.lit(float(samples)) * chance)


def sampled_softmax(rows: DataFrame, item_vectors: DataFrame, vocabulary: int, samples: int = 5,
                    seed: int = 7, row_id: str = "row_id", user_vec: str = "user_vec",
                    true_item: str = "item_id", hot_rows: int = HOT_ROWS,
                    distribution: str = UNIFORM, small_values: int = GATHER_VALUES,
                    table: Table | None = None) -> DataFrame:
    """(row_id, loss): cross-entropy of the true item against sampled ones.

    Samples are drawn from 1 .. vocabulary - 1 by a hash of (seed, row, number), uniformly
    or log-uniformly; a draw that hits the true item is left out. Log-uniform logits, the
    true item's too, are lowered by the logarithm of the expected count (codes then should be
    in order of falling frequency; the padding code 0 is left as it is). An item without a
    vector counts as the zero vector, so no row is lost and no draw left out. Rows carry their
    vector to the items only if these have more than ``small_values`` values, or an id twice.
    ``table``: the item vectors, if the caller has them for look-ups already.
    """
    if distribution not in (UNIFORM, LOG_UNIFORM):
        raise ValueError("distribution must be uniform or log_uniform")
    classes = vocabulary - 1

    def draw(s: Column) -> Column:
        text = F.concat_ws(":", F.lit(str(seed)), F.col(row_id).cast("string"), s.cast("string"))
        return _draw(text, classes, distribution)

    own = F.col(true_item).cast("bigint")
    negatives = F.filter(F.transform(F.sequence(F.lit(0), F.lit(samples - 1)), draw),
                         lambda c: c != own)
    vectors = item_vectors.select(F.col("item_id").cast("bigint").alias("idx"), "vec")
    small = table if small_values else None
    if small is None and small_values:
        dim = vectors.agg(F.max(F.size("vec"))).first()[0] or 0
        small = table_of(vectors, dim, small_values) if dim else None
    if small is not None and small.distinct:
        def lower(c: Column) -> Column:
            if distribution == UNIFORM:
                return F.lit(0.0)
            return F.when(c > 0, _log_expected(c, classes, samples, distribution)).otherwise(0.0)

        asked = rows.select(row_id, user_vec, F.concat(F.array(own), negatives).alias(INDEX))
        return score_lists(asked.withColumn("_lower", F.transform(INDEX, lower)), small, row_id,
                           user_vec, "_lower", "loss")
    flat = rows.select(row_id, user_vec, own.alias("_true"),
                       F.explode(F.concat(F.array(own), negatives)).alias("_cand"))
    joined = item_vectors.select(F.col("item_id").cast("bigint").alias("_cand"),
                                 F.col("vec").alias("_item"))
    logit = F.coalesce(dot(F.col(user_vec), F.col("_item")), F.lit(0.0))
    if distribution != UNIFORM:
        logit = logit - F.when(F.col("_cand") > 0, _log_expected(
            F.col("_cand"), classes, samples, distribution)).otherwise(0.0)
    scored = (skew_join(flat, joined, ["_cand"], "left", hot_rows)
              .select(row_id, (F.col("_cand") == F.col("_true")).alias("_own"),
                      logit.alias("_logit")))
    grouped = scored.groupBy(row_id).agg(
        F.collect_list("_logit").alias("_logits"),
        F.max(F.when(F.col("_own"), F.col("_logit"))).alias("_own"))
    spread = let(F.array_max("_logits"), lambda top: top + F.log(
        F.aggregate("_logits", F.lit(0.0), lambda s, x: s + F.exp(x - top))))
    return grouped.select(row_id, (spread - F.col("_own")).alias("loss"))


def mean_loss(losses: DataFrame) -> DataFrame:
    return losses.agg(F.avg("loss").alias("loss"))


# --- learned vectors --------------------------------------------------------

def learn_vectors(interactions: DataFrame, rank: int = 16, iterations: int = 5, seed: int = 2020,
                  user: str = "user_id", item: str = "item_id") -> ALSModel:
    """Item and user vectors from clicks by implicit-feedback factorisation."""
    counts = (interactions.groupBy(user, item).agg(F.count(F.lit(1)).cast("float").alias("clicks"))
              .select(F.col(user).cast("int").alias(user), F.col(item).cast("int").alias(item),
                      "clicks"))
    ensure_checkpoint_dir(interactions.sparkSession)
    als = ALS(userCol=user, itemCol=item, ratingCol="clicks", implicitPrefs=True, rank=rank,
              maxIter=iterations, seed=seed, coldStartStrategy="drop", checkpointInterval=2)
    return als.fit(counts)


def item_vectors(model: ALSModel, name: str = "item_id") -> DataFrame:
    """Learned item factors in the shape of an embedding table."""
    return model.itemFactors.select(F.lit(name).alias("embedding_name"),
                                    F.col("id").cast("bigint").alias("idx"),
                                    F.col("features").cast("array<double>").alias("vec"))
