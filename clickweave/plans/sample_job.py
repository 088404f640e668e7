"""Click log to model input."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from clickweave.operators.ordering import first_rows
from clickweave.operators.samples import (
    SEQUENCE_LENGTH, dictionary, encode, model_input, prefix_samples, supported,
)
from clickweave.operators.skew import HOT_ROWS
from clickweave.session import materialize


@dataclass(frozen=True)
class Prepared:
    """Everything the preparation job leaves behind."""

    kept: DataFrame
    users: DataFrame
    items: DataFrame
    samples: DataFrame
    inputs: DataFrame


def prepare(clicks: DataFrame, inum: int = 3, unum: int = 6, length: int = SEQUENCE_LENGTH,
            max_rows: int | None = None, hot_rows: int = HOT_ROWS) -> Prepared:
    """Support filters, id codes, prefix samples and padded inputs.

    The filtered clicks are read four times afterwards (two dictionaries, the
    codes, the samples), so they are written once instead of filtered again.
    """
    source = clicks.select("uid", "id", "ctime")
    if max_rows is not None:
        source = first_rows(source, ["ctime", "id", "uid"], max_rows)
    by_item, item_sizes = supported(source, "id", inum, hot_rows)
    by_user, user_sizes = supported(by_item, "uid", unum, hot_rows)
    kept = materialize(by_user, "kept")
    # Two independent jobs; together they fill the gaps each leaves on the cluster.
    with ThreadPoolExecutor(2) as pool:
        users, items = pool.map(lambda col: dictionary(kept, col), ("uid", "id"))
    coded = encode(kept, "uid", users, "user_id", hot_rows, user_sizes)
    short = items.select("id", F.col("code").cast("int").alias("code"))
    coded = encode(coded, "id", short, "item_id", hot_rows, item_sizes)
    coded_sizes = user_sizes.join(users, "uid").select(F.col("code").alias("user_id"), "n")
    samples = prefix_samples(coded, length, hot_rows=hot_rows, sizes=coded_sizes)
    return Prepared(kept, users, items, samples, model_input(samples, length))
