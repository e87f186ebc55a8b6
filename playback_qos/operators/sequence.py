"""Skew-safe "previous row of the same key" (a ``lag`` that survives hot keys).

``lag() over (partition by key order by ...)`` sends every row of a key to
one task; a key holding a third of all rows would then sort a third of the
data in one task. Here every key is cut into fixed buckets of its first order
column, whatever its size: the lag runs per (key, bucket), and the first row
of a bucket takes its predecessor from a second lag over the first and last
row of each bucket only.

One path serves all keys: nothing is sampled, counted, broadcast or switched
by size. A task sorts at most one key's rows of one bucket, so ``width`` is
chosen from the densest rate one key can have. The second lag sees at most
two rows a bucket: a year of hourly buckets is 17,520 rows of a key. Both
lags read the same shuffled rows, so the input is scanned once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: one hour, for order columns in epoch milliseconds
DEFAULT_BUCKET = 3_600_000


def with_previous(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    carry: Sequence[str],
    width: int = DEFAULT_BUCKET,
    prefix: str = "prev_",
) -> DataFrame:
    """Add ``prev_<c>`` for each ``c`` in ``carry``: its value on the previous
    row of the same ``key`` when rows are ordered by ``order`` (null on the
    first row).

    The first order column must be a non-null number; ``width`` is the bucket
    size in its unit. ``order`` should be unique within a key: rows that tie
    on all of it are put in the order of their ``carry`` values, so what comes
    out never depends on partitioning. Rows with a null ``key`` form one group.
    """
    cols = df.columns
    by = [*order, *[c for c in carry if c not in order]]
    previous = [f"{prefix}{c}" for c in carry]
    bucketed = df.withColumn("_bucket", F.floor(F.col(order[0]) / F.lit(width)))
    inside = Window.partitionBy(key, "_bucket").orderBy(*by)
    local = bucketed.withColumns(
        {p: F.lag(c).over(inside) for p, c in zip(previous, carry)}
        | {
            "_first": F.lag("_bucket").over(inside).isNull(),
            "_last": F.lead("_bucket").over(inside).isNull(),
        }
    )
    across = Window.partitionBy(key).orderBy(*by)
    edges = local.filter("_first OR _last").drop(*previous)
    linked = edges.withColumns({p: F.lag(c).over(across) for p, c in zip(previous, carry)})
    out = [*cols, *previous]
    return local.filter("NOT _first").select(*out).unionByName(linked.filter("_first").select(*out))
