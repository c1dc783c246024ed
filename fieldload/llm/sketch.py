"""Count-min sketches filled by tasks and merged by cell block.

Every task counts its 64-bit keys in ``depth`` rows of ``2**bits`` cells and
emits one row per block of cells; blocks are added up in two shuffles (by
block and salt, then by block) or in one, so no task holds more than its blocks
and the driver gets only the finished table, whose size is fixed by the
parameters.
A cell is at least the count of each of its keys.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .names import free_names

BLOCK_BITS = 18
SALTS = 16
SCHEMA = "block int, salt int, cells binary, counts binary"
CELL_MAX = 65535
# Up to here a task counts in an array of all cells, beyond in sorted keys.
DENSE_BITS = 22


def cells(keys: np.ndarray, depth_row: int, bits: int) -> np.ndarray:
    """Cell of each key in one row of the sketch."""
    odd = np.uint64((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)[depth_row])
    return ((keys * odd) >> np.uint64(64 - bits)).astype(np.int64)


def _emit(table: dict[int, np.ndarray], salt: int) -> Iterator[pa.RecordBatch]:
    for block, acc in table.items():
        at = np.flatnonzero(acc)
        if not len(at):
            continue
        sparse = len(at) * 3 < len(acc)
        counts = (acc[at] if sparse else acc).astype(np.uint16)
        yield pa.RecordBatch.from_pydict(
            {
                "block": pa.array([block], pa.int32()),
                "salt": pa.array([salt], pa.int32()),
                "cells": pa.array([at.astype(np.uint32).tobytes() if sparse else b""], pa.binary()),
                "counts": pa.array([_packed(counts)], pa.binary()),
            }
        )


def _packed(counts: np.ndarray) -> bytes:
    """Counts of one task are mostly 0 to 3: a byte or less for each key after this."""
    return zlib.compress(counts.astype(np.uint16).tobytes(), 1)


def fill(df: DataFrame, keys: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], bits: int, depth: int) -> DataFrame:
    """Partial blocks of the keys that ``keys`` yields for each task's batches."""
    block_bits = min(BLOCK_BITS, bits)
    per_row = 1 << (bits - block_bits)

    def run(batches):
        from pyspark import TaskContext

        salt = TaskContext.get().partitionId() % SALTS
        if bits <= DENSE_BITS:
            acc = np.zeros((depth, 1 << bits), np.uint32)
            for k in keys(batches):
                for row in range(depth):
                    np.add.at(acc[row], cells(k, row, bits), 1)
            blocks = np.minimum(acc, CELL_MAX, out=acc).reshape(depth * per_row, -1)
            for b in range(len(blocks)):
                yield from _emit({b: blocks[b]}, salt)
            return
        waiting: list[np.ndarray] = []
        n = 0
        for k in keys(batches):
            waiting.append(k)
            n += len(k)
            if n >= 1 << 19:
                yield from flush(waiting, salt)
                waiting, n = [], 0
        yield from flush(waiting, salt)

    def flush(waiting, salt):
        if not waiting:
            return
        k = np.concatenate(waiting)
        for row in range(depth):
            c = cells(k, row, bits)
            c, counts = np.unique(c, return_counts=True)
            cut = np.searchsorted(c >> block_bits, np.arange(per_row + 1))
            for b in np.flatnonzero(np.diff(cut)):
                s = slice(cut[b], cut[b + 1])
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array([row * per_row + int(b)], pa.int32()),
                        "salt": pa.array([salt], pa.int32()),
                        "cells": pa.array([(c[s] & ((1 << block_bits) - 1)).astype(np.uint32).tobytes()], pa.binary()),
                        "counts": pa.array([_packed(np.minimum(counts[s], CELL_MAX))], pa.binary()),
                    }
                )

    return df.mapInArrow(run, SCHEMA)


def _added(df: DataFrame, block_bits: int, finish: Callable[[np.ndarray], bytes] | None) -> DataFrame:
    def run(batches):
        acc, at_block = None, None

        def done():
            if acc is None:
                return
            if finish is None:
                yield from _emit({at_block: acc}, 0)
                return
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([at_block], pa.int32()),
                    "salt": pa.array([0], pa.int32()),
                    "cells": pa.array([b""], pa.binary()),
                    "counts": pa.array([finish(acc)], pa.binary()),
                }
            )

        for batch in batches:
            for block, at, counts in zip(batch["block"].to_pylist(), batch["cells"], batch["counts"], strict=True):
                if block != at_block:
                    yield from done()
                    acc, at_block = np.zeros(1 << block_bits, np.uint32), block
                n = np.frombuffer(zlib.decompress(counts.as_buffer()), np.uint16)
                at = np.frombuffer(at.as_buffer(), np.uint32) if at.as_buffer().size else slice(None)
                # Cells of a row are distinct.
                acc[at] = np.minimum(acc[at] + n, CELL_MAX)
        yield from done()

    return df.mapInArrow(run, SCHEMA)


def merged(parts: DataFrame, bits: int, depth: int, finish: Callable[[np.ndarray], bytes], cell_bits: int, salted: bool = True) -> np.ndarray:
    """The finished sketch as a ``(depth, bytes)`` array.

    ``finish`` turns the counts of a block into its final bytes (``cell_bits``
    a cell); the result is ``depth * 2**bits * cell_bits / 8`` bytes whatever
    the input.  Sketches of few keys and many blocks are added up in one
    shuffle (not ``salted``).
    """
    block_bits = min(BLOCK_BITS, bits)
    n_blocks = depth << (bits - block_bits)
    once = _added(parts.repartition("block", "salt").sortWithinPartitions("block"), block_bits, None) if salted else parts
    done = _added(once.repartition("block").sortWithinPartitions("block"), block_bits, finish)
    size = (1 << block_bits) * cell_bits // 8
    out = np.zeros((n_blocks, size), np.uint8)
    for r in done.select("block", "counts").collect():
        out[r["block"]] = np.frombuffer(bytes(r["counts"]), np.uint8)
    return out.reshape(depth, -1)


def repeated(acc: np.ndarray) -> bytes:
    """Bitmap of the cells counted twice or more."""
    return np.packbits(acc >= 2, bitorder="little").tobytes()


def passes(bitmaps: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    """Whether the bitmaps hold each key's cells (never false for a key that was put in)."""
    ok = np.ones(len(keys), dtype=bool)
    for row in range(len(bitmaps)):
        c = cells(keys, row, bits)
        ok &= (bitmaps[row][c >> 3] >> (c & 7).astype(np.uint8)) & 1 == 1
    return ok


def members(keys: DataFrame, bits: int = 24, depth: int = 2) -> np.ndarray:
    """Bitmaps that hold every 64-bit key of the one-column frame ``keys`` (and may pass others).

    They only spare work before a join: ``depth * 2**bits`` bits whatever the
    number of keys, so with very many keys they pass more, and drop none.
    """
    name = keys.columns[0]

    def read(batches):
        for batch in batches:
            yield batch[name].to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)

    def present(acc):
        return np.packbits(acc > 0, bitorder="little").tobytes()

    # Keys are rows or pairs of them, not the hundreds of n-grams of each text.
    return merged(fill(keys, read, bits, depth), bits, depth, present, 1, salted=False)


def by_membership(df: DataFrame, key, keys: DataFrame, then=None, schema=None) -> tuple[DataFrame, DataFrame]:
    """``df`` in two parts: rows whose ``key`` is surely not in ``keys``, and the rest.

    Only the rest needs a join with ``keys``; the first part is not shuffled.
    ``then`` maps the batches of the first part (which have one more column) to
    those of ``schema`` in the same Python worker: another ``mapInArrow`` on top
    would hold a second worker for every running task.
    """
    seen = df.sparkSession.sparkContext.broadcast(members(keys))
    (key_at,) = free_names(df.columns, 1)
    keyed = df.withColumn(key_at, key)

    def part(inside: bool):
        def run(batches):
            for batch in batches:
                hit = passes(seen.value, batch[key_at].to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), 24)
                yield batch.filter(pa.array(hit == inside))

        return run

    clear = keyed.mapInArrow(part(False), keyed.schema).drop(key_at)
    if then is not None:
        unseen = part(False)
        clear = keyed.mapInArrow(lambda batches: then(unseen(batches)), schema)
    return clear, keyed.mapInArrow(part(True), keyed.schema).drop(key_at)
