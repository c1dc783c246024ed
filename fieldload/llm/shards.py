"""Sharding over fixed virtual slots.

All of it is DataFrame work; no Python runs on the executors.

1. *Records*: id, size and text checksum are all that is moved.  Rows equal in
   the three are counted before any shuffle and numbered as copies, so a record
   repeated by a third of all rows is hashed into many slots.
2. *Slots*: the md5 of record and copy picks one of a fixed number of virtual
   slots, in the thousands.  The number never changes, so a record keeps its
   slot for good.
3. *Map*: a table ``slot -> shard``, one row a slot, kept as numbered versions.
   Shards over their fair share of bytes give up their smallest slots, which go
   one by one, largest first, to the shard with the fewest bytes.  All other
   slots stay where the version before had them.
4. *Places*: the rows of a shard are ordered by slot and md5.  A window counts
   inside one md5 range of one slot, which holds a bounded number of rows;
   offsets come from the table of ranges.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.stage import cut
from ..session import checkpoint_dir

SLOTS = 4096
# Bytes that a record costs beside its text.
RECORD_BYTES = 8
# Rows of one slot that one window sorts, about.
RANGE_ROWS = 1 << 17


def records(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, size, text_crc32, key, home`` of every row; ``home`` is its virtual slot.

    Null texts count as empty.  Equal rows are copies 1, 2, ... and have keys
    of their own.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    narrow = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + RECORD_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    counted = narrow.groupBy("id", "size", "text_crc32").agg(F.count("*").alias("n"))
    copies = counted.select("id", "size", "text_crc32", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))
    parts = [F.coalesce(F.col("id").cast("string"), F.lit("")), *[F.col(c).cast("string") for c in ("size", "text_crc32", "copy")]]
    keyed = copies.select("id", "size", "text_crc32", F.md5(F.concat_ws("|", *parts)).alias("key"))
    return keyed.withColumn("home", F.pmod(_number(F.substring("key", 1, 8)), F.lit(slots)))


def _number(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("long")


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """``home, shard``: slots dealt in turn, before any bytes are known."""
    return spark.range(slots).select(F.col("id").alias("home"), F.pmod("id", F.lit(shards)).cast("int").alias("shard"))


def slot_bytes(found: DataFrame) -> DataFrame:
    """``home, bytes, rows`` of the slots that hold records."""
    return found.groupBy("home").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def _given_up(slot_map: DataFrame, load: DataFrame, shards: int) -> DataFrame:
    """``slot_map`` with ``bytes`` and whether the slot is ``freed``.

    A shard keeps its largest slots up to a ``shards``-th of all bytes, at least
    one.  The map has a fixed number of rows, so the windows are bounded.
    """
    sized = slot_map.join(load.select("home", "bytes"), "home", "left").select("home", "shard", F.coalesce("bytes", F.lit(0)).alias("bytes"))
    largest = Window.partitionBy("shard").orderBy(F.desc("bytes"), "home")
    upto = F.sum("bytes").over(largest.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("bytes").over(Window.partitionBy(F.lit(0)))
    over = (upto * shards > total) & (F.row_number().over(largest) > 1) & (F.col("bytes") > 0)
    return sized.select("home", "shard", "bytes", over.alias("freed"))


def rebalance(slot_map: DataFrame, load: DataFrame, shards: int) -> DataFrame:
    """The map edited so that shards hold near equal bytes: ``home, shard``.

    Only freed slots move.  They are dealt over an array of ``shards`` loads,
    largest first, ties to the smaller slot and shard.
    """
    judged = cut(_given_up(slot_map, load, shards), "slot-bytes")
    kept = judged.where("not freed").groupBy("shard").agg(F.sum("bytes").alias("bytes"))
    every = slot_map.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    loads = every.join(kept, "shard", "left").select(
        F.struct("shard", F.coalesce("bytes", F.lit(0)).alias("bytes")).alias("load"), F.lit(None).cast("struct<less:long,home:long>").alias("slot")
    )
    freed = judged.where("freed").select(
        F.lit(None).cast("struct<shard:int,bytes:long>").alias("load"), F.struct((-F.col("bytes")).alias("less"), "home").alias("slot")
    )
    # At most one row a shard and a slot: a bounded list.
    lists = loads.unionByName(freed).agg(F.array_sort(F.collect_list("load")).alias("loads"), F.array_sort(F.collect_list("slot")).alias("slots"))
    dealt = lists.select(F.expr("""
        aggregate(slots,
          named_struct('loads', transform(loads, x -> x.bytes), 'to', cast(array() AS array<struct<home:bigint,shard:int>>)),
          (acc, s) -> named_struct(
            'loads', transform(acc.loads, (x, i) -> if(i + 1 = array_position(acc.loads, array_min(acc.loads)), x - s.less, x)),
            'to', array_append(acc.to, named_struct('home', s.home, 'shard', cast(array_position(acc.loads, array_min(acc.loads)) - 1 AS int)))),
          acc -> acc.to)""").alias("to"))
    moved = dealt.select(F.inline("to")).select("home", F.col("shard").alias("new_shard"))
    return judged.join(moved, "home", "left").select("home", F.coalesce("new_shard", "shard").alias("shard"))


def grow(slot_map: DataFrame, load: DataFrame, shards: int) -> DataFrame:
    """The map for one shard more than ``shards``: every shard gives its smallest slots over the new fair share to it."""
    judged = _given_up(slot_map, load, shards + 1)
    return judged.select("home", F.when(F.col("freed"), F.lit(shards)).otherwise(F.col("shard")).cast("int").alias("shard"))


# ------------------------------------------------------------ versions


def versions(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the stored maps, ascending."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath() for s in fs.listStatus(path)] if fs.exists(path) else []
    done = [p.getName() for p in names if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(n.removeprefix("version-")) for n in done if n.startswith("version-"))


def write_map(slot_map: DataFrame, base: str, version: int) -> DataFrame:
    """Store a version (one that exists is an error) and return it."""
    spark = slot_map.sparkSession
    slot_map.select("home", "shard").coalesce(1).write.mode("errorifexists").parquet(f"{base}/version-{version:010d}")
    return read_map(spark, base, version)


def read_map(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """A stored version, by default the latest."""
    version = versions(spark, base)[-1] if version is None else version
    return spark.read.schema("home long, shard int").parquet(f"{base}/version-{version:010d}")


# ------------------------------------------------------------ records to shards


def place(found: DataFrame, slot_map: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``id, size, text_crc32, home, shard, slot`` of every record; ``slot`` counts from 0 within the shard."""
    fullest = found.groupBy("home").agg(F.count("*").alias("rows")).agg(F.max("rows")).first()[0] or 0
    ranges = max(1, math.ceil(fullest / range_rows))
    # Ranges of the next 32 bits follow the order of the key behind its first 8 digits.
    part = F.shiftright(_number(F.substring("key", 9, 8)) * ranges, 32)
    order = F.substring("key", 9, 24)
    ranged = found.withColumn("range", part).withColumn("order", order)
    inside = Window.partitionBy("home", "range").orderBy("order", "id", "size", "text_crc32")
    counted = ranged.groupBy("home", "range").agg(F.count("*").alias("n")).join(slot_map, "home")
    before = Window.partitionBy("shard").orderBy("home", "range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut(counted.select("home", "range", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "slot-offsets")
    numbered = ranged.withColumn("place", F.row_number().over(inside) - 1)
    return numbered.join(offsets, ["home", "range"]).select(
        "id", "size", "text_crc32", "home", "shard", (F.col("before") + F.col("place")).cast("long").alias("slot")
    )


def shard(
    docs: DataFrame,
    shards: int = 24,
    base: str | None = None,
    slots: int = SLOTS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id, size, text_crc32, home, shard, slot`` of every row, shards of near equal bytes.

    ``base`` holds the versions of the map: the latest is edited for these rows
    and stored as the next one, or a first one is made.  Without ``base`` it is
    a new folder under the checkpoint folder.  Reruns over one version agree.
    Null ids and texts are values (size 8, checksum 0); rows equal in all three
    columns are interchangeable; an empty table leaves the map as it is.  Other
    columns are not read.
    """
    import uuid

    spark = docs.sparkSession
    base = base or f"{checkpoint_dir(spark).rstrip('/')}/slot-maps/{uuid.uuid4().hex}"
    found = cut(records(docs, slots, id_col, text_col), "slot-records")
    past = versions(spark, base)
    current = read_map(spark, base, past[-1]) if past else write_map(first_map(spark, shards, slots), base, 1)
    version = past[-1] if past else 1
    current = write_map(rebalance(current, slot_bytes(found), shards), base, version + 1)
    return place(found, current).withColumnRenamed("id", id_col)
