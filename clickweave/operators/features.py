"""Feature specifications and embedding jobs on tables.

Samples are a table with one row per ``row_id``; an embedding table holds
(embedding_name, idx, vec). Index 0 is padding and its vector is zero, so
padded positions never enter a join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from clickweave.functions.arrays import elementwise
from clickweave.functions.hashing import bucket, standard_normal
from clickweave.operators import gather
from clickweave.operators.gather import GATHER_VALUES, POOLING_EPS, POOLING_FLOOR
from clickweave.operators.skew import HOT_ROWS, fits_broadcast, skew_join
from clickweave.session import materialize

DEFAULT_GROUP = "default_group"

_KINDS = {"int32": T.IntegerType(), "int64": T.LongType(), "float32": T.FloatType(),
          "float64": T.DoubleType(), "string": T.StringType()}


@dataclass(frozen=True)
class SparseFeature:
    """One id column with its vocabulary and embedding."""

    name: str
    vocabulary_size: int
    embedding_dim: int | str = 4
    use_hash: bool = False
    dtype: str = "int32"
    embedding_name: str | None = None
    group_name: str = DEFAULT_GROUP
    trainable: bool = True

    @property
    def table(self) -> str:
        return self.embedding_name or self.name

    @property
    def dim(self) -> int:
        if self.embedding_dim == "auto":
            return 6 * int(self.vocabulary_size ** 0.25)
        return int(self.embedding_dim)


@dataclass(frozen=True)
class SequenceFeature:
    """A padded list of ids, with the columns of its length and weights."""

    sparse: SparseFeature
    maxlen: int
    combiner: str = "mean"
    length_name: str | None = None
    weight_name: str | None = None
    weight_norm: bool = True

    @property
    def name(self) -> str:
        return self.sparse.name

    @property
    def group_name(self) -> str:
        return self.sparse.group_name


@dataclass(frozen=True)
class DenseFeature:
    """A number or a fixed-size list of numbers, with an optional transform."""

    name: str
    dimension: int = 1
    dtype: str = "float32"
    transform: Callable[[Column], Column] | None = None


Feature = SparseFeature | SequenceFeature | DenseFeature


def feature_schema(features: Sequence[Feature]) -> T.StructType:
    """One column per sparse or dense feature; list, weights and length per sequence."""
    out: dict[str, T.DataType] = {}
    for f in features:
        if isinstance(f, SparseFeature):
            out[f.name] = _KINDS[f.dtype]
        elif isinstance(f, DenseFeature):
            kind = _KINDS[f.dtype]
            out[f.name] = kind if f.dimension == 1 else T.ArrayType(kind)
        elif isinstance(f, SequenceFeature):
            out[f.name] = T.ArrayType(_KINDS[f.sparse.dtype])
            if f.weight_name is not None:
                out[f.weight_name] = T.ArrayType(T.FloatType())
            if f.length_name is not None:
                out[f.length_name] = T.IntegerType()
        else:
            raise TypeError(f"not a feature: {type(f).__name__}")
    return T.StructType([T.StructField(n, t) for n, t in out.items()])


def project_features(df: DataFrame, features: Sequence[Feature], keep: Sequence[str] = ()) -> DataFrame:
    """The columns the features need, cast to their types."""
    schema = feature_schema(features)
    return df.select(*keep, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def feature_violations(df: DataFrame, features: Sequence[Feature]) -> DataFrame:
    """(feature, rows): how many rows break the declared vocabulary, length or dimension."""
    checks: list[tuple[str, Column]] = []
    for f in features:
        col = F.col(f.name)
        if isinstance(f, SparseFeature):
            if not f.use_hash:
                checks.append((f.name, col.isNull() | (col < 0) | (col >= f.vocabulary_size)))
        elif isinstance(f, SequenceFeature):
            bad = F.size(col) != f.maxlen
            if not f.sparse.use_hash:
                top = f.sparse.vocabulary_size
                bad = bad | F.exists(col, lambda x: (x < 0) | (x >= top))
            checks.append((f.name, col.isNull() | bad))
        elif f.dimension > 1:
            checks.append((f.name, col.isNull() | (F.size(col) != f.dimension)))
        else:
            checks.append((f.name, col.isNull()))
    counts = [F.sum(F.when(bad, 1).otherwise(0)).alias(f"c{i}") for i, (_, bad) in enumerate(checks)]
    rows = F.array(*[F.struct(F.lit(name).alias("feature"), F.col(f"c{i}").alias("n_rows"))
                     for i, (name, _) in enumerate(checks)])
    return df.agg(*counts).select(F.inline(rows))


@dataclass(frozen=True)
class FeatureGroups:
    """User features by kind; histories are the sequences named after an item feature."""

    sparse: list[SparseFeature]
    dense: list[DenseFeature]
    history: list[SequenceFeature]
    other_sequences: list[SequenceFeature]


def route_features(user: Sequence[Feature], item: Sequence[SparseFeature]) -> FeatureGroups:
    if len(item) != 1:
        raise ValueError("exactly one item feature is supported")
    wanted = {f"hist_{f.name}" for f in item}
    sequences = [f for f in user if isinstance(f, SequenceFeature)]
    return FeatureGroups(
        sparse=[f for f in user if isinstance(f, SparseFeature)],
        dense=[f for f in user if isinstance(f, DenseFeature)],
        history=[f for f in sequences if f.name in wanted],
        other_sequences=[f for f in sequences if f.name not in wanted])


# --- embedding tables and look-ups ------------------------------------------

def embedding_table(indices: DataFrame, name: str, dim: int, seed: int = 2020,
                    stddev: float = 1e-4, idx: str = "idx") -> DataFrame:
    """(embedding_name, idx, vec): normal(0, stddev) drawn from (seed, name, idx, dimension).

    The vector of index 0 is zero.
    """
    def cell(d: Column) -> Column:
        drawn = standard_normal(str(seed), name, F.col(idx).cast("string"), d.cast("string"))
        return F.when(F.col(idx) == 0, F.lit(0.0)).otherwise(drawn * F.lit(stddev))

    vec = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), cell)
    return indices.select(F.lit(name).alias("embedding_name"), F.col(idx).alias("idx"),
                          vec.alias("vec"))


def embedding_tables(spark, features: Sequence[SparseFeature | SequenceFeature],
                     seed: int = 2020, stddev: float = 1e-4) -> DataFrame:
    """One table for every embedding name; item and history features share theirs."""
    specs: dict[str, SparseFeature] = {}
    for f in features:
        sparse = f.sparse if isinstance(f, SequenceFeature) else f
        specs[sparse.table] = sparse
    out = None
    for name, f in specs.items():
        one = embedding_table(spark.range(f.vocabulary_size).withColumnRenamed("id", "idx"),
                              name, f.dim, seed, stddev)
        out = one if out is None else out.unionByName(one)
    return out


def _table(emb: DataFrame, name: str, key: str, vec: str) -> DataFrame:
    return (emb.where(F.col("embedding_name") == name)
            .select(F.col("idx").alias(key), F.col("vec").alias(vec)))


UNKNOWN = ("zero", "fail")


def vector_or_zero(vec: Column, dim: int, index: Column, unknown: str = "zero") -> Column:
    """The vector found for ``index``, else zeros.

    Index 0 is padding and always has the zero vector. Any other index without a
    vector gets it too, or ends the job when ``unknown`` is "fail".
    """
    if unknown not in UNKNOWN:
        raise ValueError(f"unknown must be one of {UNKNOWN}")
    zeros = F.array_repeat(F.lit(0.0), dim)
    if unknown == "zero":
        return F.coalesce(vec, zeros)
    message = F.concat(F.lit("no vector for index "), F.coalesce(index.cast("string"), F.lit("NULL")))
    return (F.when(vec.isNotNull(), vec).when(index == 0, zeros)
            .otherwise(F.raise_error(message)))


def lookup(rows: DataFrame, emb: DataFrame, feature: SparseFeature, out: str | None = None,
           mask_zero: bool = False, hot_rows: int = HOT_ROWS, unknown: str = "zero",
           small_values: int = GATHER_VALUES, broadcast: bool = True) -> DataFrame:
    """Adds the vector of one id column. Every row stays, see :func:`vector_or_zero`.

    Rows are shuffled only if the table has more than ``small_values`` values, or an id twice.
    Without ``broadcast`` tables that a broadcast join would take are looked up in batches too.
    """
    if unknown not in UNKNOWN:
        raise ValueError(f"unknown must be one of {UNKNOWN}")
    out = out or f"{feature.name}_vec"
    index = F.col(feature.name)
    if feature.use_hash:
        index = bucket(index, feature.vocabulary_size, mask_zero)
    table = _table(emb, feature.table, "_idx", out)
    if small_values and not (broadcast and fits_broadcast(table)):
        small = gather.vector_table(emb, feature.table, feature.dim, small_values)
        if small is not None and small.distinct:
            return gather.look_up(rows.withColumn(gather.INDEX, index.cast("bigint")), small, out,
                                  unknown)
    keyed = rows.withColumn("_idx", index.cast("bigint"))
    found = skew_join(keyed, table, ["_idx"], "left", hot_rows)
    vec = vector_or_zero(F.col(out), feature.dim, F.col("_idx"), unknown)
    return found.withColumn(out, vec).drop("_idx")


def lookup_groups(rows: DataFrame, emb: DataFrame, features: Sequence[SparseFeature],
                  only: Sequence[str] = (), masked: Sequence[str] = (), hot_rows: int = HOT_ROWS,
                  small_values: int = GATHER_VALUES,
                  broadcast: bool = True) -> tuple[DataFrame, dict[str, list[str]]]:
    """Vectors of several id columns, and the vector columns of each feature group."""
    groups: dict[str, list[str]] = {}
    for f in features:
        if only and f.name not in only:
            continue
        rows = lookup(rows, emb, f, mask_zero=f.name in masked, hot_rows=hot_rows,
                      small_values=small_values, broadcast=broadcast)
        groups.setdefault(f.group_name, []).append(f"{f.name}_vec")
    return rows, groups


def list_index(feature: SequenceFeature) -> Callable[[Column], Column] | None:
    """Table index of one id of the list; None if the id is the index."""
    if feature.sparse.use_hash:
        return lambda x: bucket(x, feature.sparse.vocabulary_size, mask_zero=True)
    return None


def small_table(emb: DataFrame, feature: SequenceFeature,
                small_values: int = GATHER_VALUES) -> gather.Table | None:
    """The feature's vectors if they may go to every task."""
    return gather.vector_table(emb, feature.sparse.table, feature.sparse.dim, small_values)


def sequence_lookup(rows: DataFrame, emb: DataFrame, feature: SequenceFeature,
                    row_id: str = "row_id", hot_rows: int = HOT_ROWS, unknown: str = "zero",
                    small_values: int = GATHER_VALUES) -> DataFrame:
    """(row_id, pos, [weight, weight_lse,] vec) for every position that counts, known id or not.

    A position counts while it is below the length column, or, without one,
    while its id is not 0. A vector table of up to ``small_values`` values is looked up in
    the batches that hold the lists; beyond that, positions are joined. Padding ids are
    dropped before the join: they would be by far the hottest key and their vector is zero.
    """
    if unknown not in UNKNOWN:
        raise ValueError(f"unknown must be one of {UNKNOWN}")
    table = small_table(emb, feature, small_values)
    flat = gather.flat_lists(gather.with_index(rows, feature.name, list_index(feature)), table,
                             row_id, feature.length_name, feature.weight_name, unknown)
    if table is not None:
        return flat
    vectors = _table(emb, feature.sparse.table, "_idx", "vec")
    found = skew_join(flat, vectors, ["_idx"], "left", hot_rows)
    vec = vector_or_zero(F.col("vec"), feature.sparse.dim, F.col("_idx"), unknown)
    return found.withColumn("vec", vec).drop("_idx")


# --- pooling ----------------------------------------------------------------

def weight_positions(vectors: DataFrame, normalise: bool = True, row_id: str = "row_id",
                     weight: str = "weight") -> DataFrame:
    """Vectors times their weight; weights of a row pass a softmax first if wanted.

    :func:`sequence_lookup` gives the softmax's denominator with each position. Without it a
    window adds it up: a row has at most as many positions as the padded length.
    """
    w = F.col(weight).cast("double")
    factor = w
    if normalise and gather.WEIGHT_LSE in vectors.columns:
        factor = F.exp(w - F.col(gather.WEIGHT_LSE))
    elif normalise:
        span = Window.partitionBy(row_id)
        vectors = (vectors.withColumn("_e", F.exp(w - F.max(w).over(span)))
                   .withColumn("_f", F.col("_e") / F.sum("_e").over(span)))
        factor = F.col("_f")
    return (vectors.withColumn("_w", factor)
            .withColumn("vec", F.transform("vec", lambda x: x * F.col("_w")))
            .drop("_e", "_f", "_w", weight, gather.WEIGHT_LSE))


def pool_positions(rows: DataFrame, vectors: DataFrame, mode: str, dim: int,
                   length: Column | None = None, row_id: str = "row_id",
                   out: str = "pooled") -> DataFrame:
    """(row_id, pooled): sum, mean or max over the counted positions of each row.

    The mean divides by the raw length plus a small number, also where that
    length exceeds the padded one. A row without positions gives zeros, and the
    floor value for max.
    """
    if mode not in ("sum", "mean", "max"):
        raise ValueError("mode must be sum, mean or max")
    metric = "max" if mode == "max" else "sum"
    vector = array_to_vector(F.col("vec").cast("array<double>"))
    summary = Summarizer.metrics(metric, "count").summary(vector)
    grouped = vectors.groupBy(row_id).agg(summary.alias("_s"))
    grouped = grouped.select(row_id, vector_to_array(F.col(f"_s.{metric}")).alias("_v"),
                             F.col("_s.count").alias("_count"))
    empty = F.array_repeat(F.lit(POOLING_FLOOR if mode == "max" else 0.0), dim)
    size = F.coalesce("_count" if length is None else "_len", F.lit(0))
    base = rows.select(row_id) if length is None else rows.select(row_id, length.alias("_len"))
    value = F.coalesce("_v", empty)
    if mode == "mean":
        value = F.transform(value, lambda x: x / (size.cast("double") + F.lit(POOLING_EPS)))
    return base.join(grouped, row_id, "left").select(row_id, value.alias(out))


def pool_modes(rows: DataFrame, emb: DataFrame, feature: SequenceFeature, modes: dict[str, str],
               row_id: str = "row_id", hot_rows: int = HOT_ROWS,
               small_values: int = GATHER_VALUES) -> DataFrame:
    """``rows`` with a pooled vector per entry (column: mode) of ``modes``; one look-up for all."""
    table = small_table(emb, feature, small_values)
    if table is not None:
        indexed = gather.with_index(rows, feature.name, list_index(feature))
        return gather.pool_lists(indexed, table, modes, feature.length_name, feature.weight_name,
                                 feature.weight_norm)
    vectors = sequence_lookup(rows, emb, feature, row_id, hot_rows, small_values=small_values)
    if feature.weight_name:
        vectors = weight_positions(vectors, feature.weight_norm, row_id)
    if len(modes) > 1:
        vectors = materialize(vectors, "positions")
    length = F.col(feature.length_name) if feature.length_name else None
    for column, mode in modes.items():
        pooled = pool_positions(rows.select(row_id, *filter(None, [feature.length_name])), vectors,
                                mode, feature.sparse.dim, length, row_id, column)
        rows = rows.join(pooled, row_id)
    return rows


def pool_feature(rows: DataFrame, emb: DataFrame, feature: SequenceFeature,
                 row_id: str = "row_id", hot_rows: int = HOT_ROWS,
                 small_values: int = GATHER_VALUES) -> DataFrame:
    """(row_id, vector): one sequence feature from ids to a pooled vector, weighted if it
    has weights."""
    out = f"{feature.name}_vec"
    needed = filter(None, dict.fromkeys([row_id, feature.name, feature.length_name,
                                         feature.weight_name]))
    return pool_modes(rows.select(*needed), emb, feature, {out: feature.combiner}, row_id, hot_rows,
                      small_values).select(row_id, out)


def pool_features(rows: DataFrame, emb: DataFrame, features: Sequence[SequenceFeature],
                  row_id: str = "row_id", hot_rows: int = HOT_ROWS,
                  small_values: int = GATHER_VALUES) -> tuple[DataFrame, dict[str, list[str]]]:
    """``rows`` with the pooled vectors of several sequence features, and their columns by group."""
    groups: dict[str, list[str]] = {}
    for f in features:
        rows = pool_modes(rows, emb, f, {f"{f.name}_vec": f.combiner}, row_id, hot_rows,
                          small_values)
        groups.setdefault(f.group_name, []).append(f"{f.name}_vec")
    return rows, groups


def assemble(rows: DataFrame, emb: DataFrame, groups: FeatureGroups, out: str = "other_vec",
             hot_rows: int = HOT_ROWS, small_values: int = GATHER_VALUES,
             broadcast: bool = True) -> DataFrame:
    """``rows`` with the user's features but the history in one vector: looked-up ids, pooled
    sequences, then dense values after their transforms."""
    rows, looked_up = lookup_groups(rows, emb, groups.sparse, hot_rows=hot_rows,
                                    small_values=small_values, broadcast=broadcast)
    rows, pooled = pool_features(rows, emb, groups.other_sequences, hot_rows=hot_rows,
                                 small_values=small_values)
    rows = dense_inputs(rows, groups.dense)
    vectors = [F.col(c) for found in (looked_up, pooled) for cols in found.values() for c in cols]
    vectors += [F.col(f.name).cast("array<double>") if f.dimension > 1
                else F.array(F.col(f.name).cast("double")) for f in groups.dense]
    if not vectors:
        raise ValueError("no feature but the history")
    return rows.withColumn(out, F.concat(*vectors))


def dense_inputs(df: DataFrame, features: Sequence[Feature]) -> DataFrame:
    """Dense features after their transforms; other features stay as they are."""
    for f in features:
        if isinstance(f, DenseFeature) and f.transform is not None:
            df = df.withColumn(f.name, f.transform(F.col(f.name)))
    return df


def pool_columns(df: DataFrame, cols: Sequence[str], mode: str, out: str) -> DataFrame:
    """Mean, max or sum of several vector columns, element by element."""
    return df.withColumn(out, elementwise([F.col(c) for c in cols], mode))


def concat_features(cols: Sequence[str]) -> Column:
    """Vectors and plain numbers side by side in one vector."""
    if not cols:
        raise ValueError("no feature to concatenate")
    return F.concat(*[F.col(c) for c in cols]) if len(cols) > 1 else F.col(cols[0])


def export_item_vectors(clicks: DataFrame, codes: DataFrame, emb: DataFrame, name: str,
                        item: str = "item_id") -> DataFrame:
    """(item, code, vec) for every distinct raw item.

    ``codes`` is (item, code); vectors are kept by code. An item outside the
    vocabulary keeps a NULL code and a NULL vector.
    """
    items = clicks.select(item).distinct()
    coded = items.join(codes.select(item, "code"), item, "left")
    return coded.join(_table(emb, name, "code", "vec"), "code", "left").select(item, "code", "vec")
