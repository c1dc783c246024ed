"""Join helpers: size-checked broadcast, insert-if-absent, key cardinality."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .stage import cut

# Largest frame that is broadcast explicitly; beyond it the join is left to
# the planner (sort-merge, or AQE's runtime broadcast by measured size).
BROADCAST_ROW_LIMIT = 200_000
BROADCAST_BYTE_LIMIT = 32 * 1024 * 1024


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT, max_bytes: int = BROADCAST_BYTE_LIMIT) -> bool:
    """Whether ``df`` holds at most ``max_rows`` rows and ``max_bytes`` of values; reads no further."""
    size = F.octet_length(F.concat_ws("", *[F.col(c).cast("string") for c in df.columns])) + 16 * len(df.columns)
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return n <= max_rows and size <= max_bytes


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast ``df`` only if it provably is small."""
    return F.broadcast(df) if is_small(df, max_rows) else df


@dataclass(frozen=True)
class IdSet:
    """Distinct ids, written once, and whether they are few enough to broadcast (measured by the write)."""

    ids: DataFrame
    small: bool

    def named(self, column: str) -> DataFrame:
        ids = self.ids.withColumnRenamed(self.ids.columns[0], column)
        return F.broadcast(ids) if self.small else ids


def id_set(ids: DataFrame, name: str) -> IdSet:
    """Write the distinct non-NULL values of a one-column frame."""
    column = ids.columns[0]
    seen = Observation()
    rows = ids.where(F.col(column).isNotNull()).distinct().observe(
        seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(F.col(column).cast("string")) + 16), F.lit(0)).alias("size")
    )
    written = cut(rows, name)
    return IdSet(written, seen.get["n"] <= BROADCAST_ROW_LIMIT and seen.get["size"] <= BROADCAST_BYTE_LIMIT)


def narrowed(df: DataFrame, ids: DataFrame | IdSet, column: str) -> DataFrame:
    """Rows of ``df`` whose ``column`` may be among ``ids`` (a one-column frame or an id set).

    A small set is broadcast, so that a small run does not shuffle a big table;
    with a large one ``df`` stays as it is, for the caller's own join to filter.
    """
    if isinstance(ids, DataFrame):
        ids = IdSet(ids, is_small(ids))
    if not ids.small:
        return df
    return df.join(ids.named(column), column, "left_semi").select(*df.columns)


def insert_absent(candidates: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``candidates`` whose natural key is not in ``existing`` (C-6).

    NULL keys never match, so they are dropped first: the reference never
    creates a row it could not look up again.
    """
    probe = candidates
    for k in keys:
        probe = probe.where(F.col(k).isNotNull())
    return probe.join(existing.select(*keys).where(F.col(keys[0]).isNotNull()), keys, "left_anti")


def key_violations(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """Natural keys that occur more than once (A7): ``(table_name, key, n)``.

    A key of several columns is shown as a JSON array, so its parts stay
    apart and NULL parts stay visible.
    """
    key = F.col(keys[0]).cast("string") if len(keys) == 1 else F.to_json(F.array(*[F.col(k).cast("string") for k in keys]))
    return (
        df.where(F.col(keys[0]).isNotNull())
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .select(F.lit(table).alias("table_name"), key.alias("key"), "n")
    )
