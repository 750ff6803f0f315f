"""Dense numbering without collecting a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def running_counts(
    df: DataFrame,
    keys: Sequence[str],
    block: str,
    order: Sequence[str],
    conditions: dict[str, str],
) -> DataFrame:
    """Add, per SQL condition, how many rows of the key up to and including this row satisfy it.

    ``block`` must be non-decreasing along ``order``. Rows are ordered only inside
    (key, block), and a key's blocks are joined up by their pre-aggregated totals, so a key
    that holds most of the rows is still spread over its blocks.
    """
    totals = df.groupBy(*keys, block).agg(
        *[F.expr(f"count_if({cond}) AS before_{name}") for name, cond in conditions.items()]
    )
    by_key, by_block = ", ".join(keys), ", ".join([*keys, block])
    earlier = f"PARTITION BY {by_key} ORDER BY {block} ROWS BETWEEN UNBOUNDED PRECEDING"
    before = totals.selectExpr(
        *keys,
        block,
        *[
            f"coalesce(sum(before_{n}) OVER ({earlier} AND 1 PRECEDING), 0) AS before_{n}"
            for n in conditions
        ],
    )
    inside = (
        f"PARTITION BY {by_block} ORDER BY {', '.join(order)} "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    )
    local = df.selectExpr(
        "*", *[f"count_if({cond}) OVER ({inside}) AS here_{n}" for n, cond in conditions.items()]
    )
    return local.join(before, [*keys, block]).selectExpr(
        *df.columns, *[f"here_{n} + before_{n} AS {n}" for n in conditions]
    )
