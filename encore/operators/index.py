"""Dense 1..n row numbering in key order, without a single-partition window.

``row_number() over (order by k)`` runs in one task. Here the rows are range-partitioned on the key itself
(Spark samples the keys for the bounds, whatever their type or common beginning), sorted within partitions and
written with their place; each partition's rows are counted, and the running sums of those counts (one row for
each partition) are added through a broadcast join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: ``monotonically_increasing_id`` holds the partition above these bits and the place in it below.
_PLACE_BITS = 33


def with_dense_index(df: DataFrame, order_col: str, out_col: str, buckets: int | None = None) -> DataFrame:
    """``df`` with ``out_col``: 1..n (double) in the order of ``order_col``; equal keys stand side by side.

    The ranges follow from the data, so any number of partitions can be used (``buckets``; the session's shuffle partitions by
    default). The placed rows are written to the checkpoint folder: bounds drawn from a sample must not be drawn again
    when a task is repeated.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = buckets or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = (df.repartitionByRange(n, order_col).sortWithinPartitions(order_col)
              .withColumn("_ix", F.monotonically_increasing_id()).checkpoint())
    part, place = F.shiftright("_ix", _PLACE_BITS), F.col("_ix").bitwiseAND((1 << _PLACE_BITS) - 1)
    counts = placed.groupBy(part.alias("_ix_b")).agg(F.count(F.lit(1)).alias("_ix_n"))
    # one row a partition
    before = Window.orderBy("_ix_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_ix_b", F.coalesce(F.sum("_ix_n").over(before), F.lit(0)).alias("_ix_off"))
    return (placed.withColumn("_ix_b", part).join(F.broadcast(offsets), "_ix_b")
            .withColumn(out_col, (F.col("_ix_off") + place + 1).cast("double"))
            .select(*[f"`{c}`" for c in df.columns], out_col))
