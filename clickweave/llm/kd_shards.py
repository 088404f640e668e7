"""Shards of equal bytes by a k-d tree over metadata.

A node that must become k shards is cut along the metadata dimension in which it
is widest, at the weighted median: the value below which lie floor(k/2)/k of its
bytes. Medians are found for all nodes of a level at once, by histograms of bytes
that are summed where the rows lie; each round looks into the one bin that holds
the median, until that bin is a single row or too light to matter. The driver sees
at most ``BINS`` sums per node and round, whatever the number of rows.

Rows with equal values are told apart by a hash of their row number, so a value, a
text or a row that a third of the table repeats is cut like any other.

Defined results: a null text has 0 bytes and crc 0; a null in a dimension counts
as 0; ids may be null or repeat; an empty table gives no rows; other columns are
ignored. Sizes differ by about one row and ``tolerance`` per level.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from clickweave.operators.ordering import with_row_index
from clickweave.session import materialize

BINS = 4096
ROW_BYTES = 8
TIE = 1 << 32
STEPS = (1 << 30) - 1


@dataclass
class Node:
    """``leaves`` shards, numbered from ``first``; ``at`` is the key up to which rows go left."""

    number: int
    first: int
    leaves: int
    weight: int = 0
    dim: int = 0
    low: float = 0.0
    high: float = 0.0
    at: int | None = None
    children: list["Node"] = field(default_factory=list)

    def key(self) -> Column:
        """Place along the node's dimension, ties by hash: a long that orders its rows."""
        value, width = F.col(f"d{self.dim}"), self.high - self.low
        step = F.floor((value - self.low) / width * STEPS) if width > 0 else F.lit(0)
        step = F.greatest(F.lit(0), F.least(F.lit(STEPS), step)).cast("long")
        return step * TIE + F.col("tie")


def place(node: Node, value) -> Column:
    """``value(leaf)`` of the frontier node that a row falls into."""
    if not node.children:
        return value(node)
    left, right = node.children
    return F.when(node.key() <= node.at, place(left, value)).otherwise(place(right, value))


def _measure(rows: DataFrame, root: Node, active: list[Node], n_dims: int,
             ranges: list[float]) -> None:
    """Weight, widest dimension and its ends for each active node: one aggregate."""
    ends = [f(f"d{i}").alias(f"{n}{i}") for i in range(n_dims) for f, n in ((F.min, "lo"),
                                                                           (F.max, "hi"))]
    found = {r["node"]: r for r in
             rows.groupBy(place(root, lambda n: F.lit(n.number)).alias("node"))
             .agg(F.sum("size").alias("weight"), *ends).collect()}
    for node in active:
        r = found.get(node.number)
        if r is None:
            continue
        spread = [(r[f"hi{i}"] - r[f"lo{i}"]) / ranges[i] if ranges[i] else 0.0
                  for i in range(n_dims)]
        node.weight = r["weight"]
        node.dim = max(range(n_dims), key=lambda i: (spread[i], -i))
        node.low, node.high = r[f"lo{node.dim}"], r[f"hi{node.dim}"]


def _medians(rows: DataFrame, root: Node, active: list[Node], tolerance: float) -> None:
    """Finds ``at`` of each active node."""
    open_ = {n.number: [n, 0, (STEPS + 1) * TIE, 0] for n in active}  # from, to, bytes below
    while open_:
        def bin_of(node: Node) -> Column:
            if node.number not in open_:
                return F.lit(None).cast("long")
            _, low, high, _ = open_[node.number]
            width = max(1, -(-(high - low) // BINS))
            inside = (node.key() >= low) & (node.key() < high)
            return F.when(inside, F.floor((node.key() - low) / width).cast("long"))

        sums = (rows.select(place(root, lambda n: F.lit(n.number)).alias("node"),
                            place(root, bin_of).alias("bin"),
                            place(root, lambda n: n.key()).alias("key"), "size")
                .where("bin IS NOT NULL").groupBy("node", "bin")
                .agg(F.sum("size").alias("bytes"), F.min("key").alias("lo"),
                     F.max("key").alias("hi")).orderBy("node", "lo").collect())
        by_node: dict[int, list] = {}
        for r in sums:
            by_node.setdefault(r["node"], []).append(r)
        for number, (node, low, high, below) in list(open_.items()):
            want = node.weight * (node.leaves // 2) / node.leaves
            for r in by_node.get(number, []):
                if below + r["bytes"] >= want:
                    break
                below += r["bytes"]
            else:
                node.at = high
                del open_[number]
                continue
            if r["lo"] == r["hi"] or r["bytes"] <= tolerance:
                nearer = want - below < below + r["bytes"] - want
                node.at = r["lo"] - 1 if nearer else r["hi"]
                del open_[number]
            else:
                open_[number] = [node, r["lo"], r["hi"] + 1, below]


def grow(rows: DataFrame, shards: int, n_dims: int, tolerance: float) -> Node:
    """The tree over rows (size, tie, d0, d1, ...); ``shards`` leaves."""
    ends = rows.agg(*[F.max(f"d{i}") - F.min(f"d{i}") for i in range(n_dims)]).first()
    ranges = [x or 0.0 for x in ends]
    root, count = Node(0, 0, shards), 1
    active = [root] if shards > 1 else []
    while active:
        _measure(rows, root, active, n_dims, ranges)
        _medians(rows, root, active, tolerance)
        grown = []
        for node in active:
            half = node.leaves // 2
            node.children = [Node(count, node.first, half),
                             Node(count + 1, node.first + half, node.leaves - half)]
            grown += node.children
            count += 2
        active = [n for n in grown if n.leaves > 1]
    return root


def number_dimension(kind: T.DataType, col: Column) -> Column:
    """A dimension as a number: strings by their hash, null as 0."""
    if isinstance(kind, T.StringType):
        col = F.when(col.isNotNull(), F.xxhash64(col))
    return F.coalesce(col.cast("double"), F.lit(0.0))


def kd_tree_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None,
                   dims: Sequence[str] = ("n_chars", "lang", "source"), id_col: str = "doc_id",
                   text_col: str = "text", tolerance: float = 1e-4) -> DataFrame:
    """(id_col, size, text_crc32, shard, slot).

    ``shards`` leaves, or as many as bring a leaf to ``target_bytes``. ``slot`` is
    the row's place in its shard, from 0 without gaps, in the order of ids.
    """
    text = F.col(f"`{text_col}`")
    kinds = {f.name: f.dataType for f in docs.schema}
    meta = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"),
        *[number_dimension(kinds[d], F.col(f"`{d}`")).alias(f"d{i}") for i, d in enumerate(dims)],
        F.monotonically_increasing_id().alias("row"))
    # Written once: the row numbers must not change between two rounds.
    rows = materialize(meta, "metadata").withColumn("tie", F.pmod(F.xxhash64("row"), F.lit(TIE)))
    if shards is None:
        if not target_bytes:
            raise ValueError("give shards or target_bytes")
        shards = max(1, -(-(rows.agg(F.sum("size")).first()[0] or 0) // target_bytes))
    whole = rows.agg(F.sum("size")).first()[0] or 0
    root = grow(rows, shards, len(dims), tolerance * whole / shards)
    placed = rows.select("id", "size", "crc", "row",
                         place(root, lambda n: F.lit(n.first)).alias("shard"))
    indexed = with_row_index(placed, ["shard", "id", "row"], "place")
    starts = indexed.groupBy("shard").agg(F.min("place").alias("start"))  # a row per shard
    return (indexed.join(F.broadcast(starts), "shard")
            .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
                    (F.col("place") - F.col("start")).alias("slot")))
