"""Dense surrogate ids without a single-partition window.

``row_number() over (order by k)`` with no partition puts every row in one
task.  Instead: range-partition and sort by the key, tag each row with its
partition and its position inside it (``monotonically_increasing_id``),
store the tags with the rows (one written pass, so a retried task cannot
change them), count rows per partition (one row per partition) and add each
partition's running offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .stage import cut

_LOW_BITS = (1 << 33) - 1


def dense_ids(
    df: DataFrame,
    order_cols: list[str] | None,
    name: str = "id",
    start: int | DataFrame = 1,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``name`` = start + 0-based rank of the row in ``order_cols`` order.

    ``start`` may be a one-row DataFrame (e.g. max existing id + 1).  Ties
    get distinct ids in an unspecified order.  With ``order_cols=None`` the
    ids are dense but follow the existing partitions: no sort, no shuffle.
    """
    spark = df.sparkSession
    if order_cols:
        n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    mono = F.monotonically_increasing_id()
    tagged = cut(
        df.withColumn("_mono", mono)
        .withColumn("_part", F.shiftright("_mono", 33))
        .withColumn("_local", F.col("_mono").bitwiseAND(F.lit(_LOW_BITS)))
        .drop("_mono"),
        "numbering",
    )
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # The first id rides along as a pseudo partition -1, so that the running
    # sum below starts from it.  One row per partition: the window is bounded
    # by the partition count, and so is the broadcast of its result.
    if isinstance(start, DataFrame):
        first = start.select(
            F.lit(-1).cast("bigint").alias("_part"),
            F.coalesce(F.col(start.columns[0]).cast("bigint"), F.lit(1)).alias("_n"),
        ).limit(1)
    else:
        first = spark.range(1).select(
            F.lit(-1).cast("bigint").alias("_part"), F.lit(int(start)).cast("bigint").alias("_n")
        )
    offsets = (
        counts.unionByName(first)
        .select(
            "_part",
            F.sum("_n")
            .over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
            .alias("_off"),
        )
        .where(F.col("_part") >= 0)
    )
    return (
        tagged.join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_off") + F.col("_local")).cast("bigint"))
        .drop("_part", "_local", "_off")
    )
