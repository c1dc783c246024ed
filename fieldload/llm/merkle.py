"""Merkle manifest of a dataset with incrementally built witnesses.

The tree of every source has its rows, ascending by id, as leaves and
``fanout`` children a node; the roots of the sources, ascending by source, are
the leaves of a last tree of the same form.

1. *Leaves* are hashed once by Spark's functions and numbered inside their
   source: a range partitioned sort, positions inside partitions, offsets by a
   table with one row for each partition and source.
2. *Appends*: leaves go, in order, into blocks aligned to ``fanout ** levels``.
   A task streams its blocks through an ``Appender``.  It keeps the open runs
   only, one for each level; a node that joins a run becomes a left sibling of
   those to come and extends the witness of those before it, and a full run
   becomes a node of the next level.  Block roots are appended in the same way
   in the next round, until a source has one node; then the sources' roots are.
3. *Witnesses* go down: a block's witness is joined to its block, whose members
   append their own in front of it.  The last round keeps digests only.

A task holds one block at a time, so a source with a third of all rows is many
blocks.  Rounds grow with the logarithm of the rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import bounded_broadcast
from ..operators.stage import cut

FANOUT = 16
# Levels of one block: 16 ** 2 leaves are appended in one stream.
LEVELS = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Node:
    """A completed node of an open run: digest and the witness of its place in the run."""

    __slots__ = ("left", "right", "value")

    def __init__(self, value: str, left: str):
        self.value, self.left, self.right = value, left, ""


class Appender:
    """Append-only tree: takes digests in order, holds one open run for each level.

    ``done[k]`` are the nodes of level ``k`` whose run is full or closed, with
    complete witnesses.
    """

    def __init__(self, fanout: int = FANOUT):
        self.fanout, self.runs, self.done = fanout, [[]], [[]]

    def append(self, value: str, level: int = 0) -> None:
        run = self.runs[level]
        for node in run:  # a later sibling extends the witnesses of the earlier ones
            node.right += value
        run.append(Node(value, "".join(n.value for n in run)))
        if len(run) == self.fanout:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.runs[level] = self.runs[level], []
        self.done[level] += run
        if len(self.runs) == level + 1:
            self.runs.append([])
            self.done.append([])
        self.append(digest("".join(n.value for n in run)), level + 1)

    def close(self, levels: int | None = None) -> str:
        """Complete all open runs up to the root (``levels`` above the leaves, or where one node remains) and return it."""
        level = 0
        while True:
            run = self.runs[level]
            alone = len(run) == 1 and not self.done[level]
            if level == levels or (levels is None and alone):
                return run[0].value
            if run:
                self._complete(level)
            level += 1

    def witness(self, leaf: int) -> list[tuple[str, str]]:
        """Left and right siblings of a leaf, level by level, after ``close``."""
        out = []
        for level in self.done:
            if leaf < len(level):
                out.append((level[leaf].left, level[leaf].right))
                leaf //= self.fanout
        return out


def fold(value: str, witness: list[tuple[str, str]]) -> str:
    """Root that a node with this witness belongs to."""
    for left, right in witness:
        value = digest(left + value + right)
    return value


# ------------------------------------------------------------ leaves


def leaf_hash(*values: Column) -> Column:
    """Hex sha256 of the fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and the field."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def tampered_text(id_col: Column, text: Column) -> Column:
    """The text with A-Z lower-cased, for ids whose decimal's CRC-32 is divisible by 5; others as they are."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, lower).otherwise(text)


def leaves(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``id, source, value, other``: leaf digest of every row, and of its tampered form where that differs."""
    values = [F.col(c) for c in fields]
    changed = [tampered_text(F.col(id_col), F.col(c)) if c == text_col else F.col(c) for c in fields]
    differs = F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0
    hashed = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), leaf_hash(*values).alias("value"),
        F.when(differs, leaf_hash(*changed)).alias("other"),
    )
    return hashed.withColumn("other", F.when(F.col("other") != F.col("value"), F.col("other")))


def numbered(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``at`` (from 0 within ``tree``, by ``order``) and ``n`` (rows of the tree) added.

    Rows equal in ``order`` can differ in nothing else that counts, so a random
    last key may part them.
    """
    spark = rows.sparkSession
    salted = rows.withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [tree, *order, "salt"]
    spread = salted.repartitionByRange(n, *keys).sortWithinPartitions(*keys).drop("salt")
    placed = cut(spread.withColumn("row", F.monotonically_increasing_id()), "merkle-sorted")
    part = F.shiftright("row", 33)
    # One row for each partition and tree that meet.
    firsts = placed.groupBy(part.alias("part"), tree).agg(F.min("row").alias("first"), F.count("*").alias("k"))
    so_far = Window.partitionBy(tree).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = cut(firsts.select(
        "part", F.col(tree).alias("of"), "first", F.coalesce(F.sum("k").over(so_far), F.lit(0)).alias("before"),
        F.sum("k").over(Window.partitionBy(tree)).alias("n"),
    ), "merkle-offsets")
    here = placed.withColumn("part", part)
    same = (here["part"] == firsts["part"]) & here[tree].eqNullSafe(firsts["of"])
    return here.join(bounded_broadcast(firsts), same).select(
        *rows.columns, (F.col("before") + F.col("row") - F.col("first")).alias("at"), "n"
    )


# ------------------------------------------------------------ rounds of appends


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows of a block together and in order."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = rows.withColumn("block", F.floor(F.col("at") / size).cast("long"))
    return block.repartition(n, "tree", "block").sortWithinPartitions("tree", "block", "at")


def _streams(batches, columns: list[str]):
    """Rows of every block as a list of tuples, across batches."""
    key, rows = None, []
    for batch in batches:
        lists = [batch.column(c).to_pylist() for c in ("tree", "block", *columns)]
        for tree, block, *row in zip(*lists, strict=True):
            if (tree, block) != key:
                if rows:
                    yield key, rows
                key, rows = (tree, block), []
            rows.append(row)
    if rows:
        yield key, rows


def _appended(values: list[str], n: int, fanout: int, levels: int) -> tuple[Appender, str]:
    """The closed block, and its root; where the tree has one block the root is the first node alone."""
    tree = Appender(fanout)
    for v in values:
        tree.append(v)
    return tree, tree.close(levels if n > fanout**levels else None)


def block_roots(rows: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Rows ``tree, at, n, value`` appended block by block: the same columns, one row a block."""
    size = fanout**levels

    def run(batches):
        out = []
        for (tree, block), members in _streams(batches, ["n", "value"]):
            n = members[0][0]
            out.append((tree, block, -(-n // size), _appended([v for _, v in members], n, fanout, levels)[1]))
            if len(out) == 4096:
                yield _batch(out)
                out = []
        yield _batch(out)

    def _batch(out):
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["tree", "at", "n", "value"])

    return _blocks(rows.select("tree", "at", "n", "value"), size).mapInArrow(run, "tree long, at long, n long, value string")


WITNESS = "array<struct<left:string,right:string>>"
WITNESS_TYPE = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
# What a block hands down to its members.
PASSED = ("witness", "subroot", "root")


def _with_above(rows: DataFrame, above: DataFrame, size: int) -> DataFrame:
    """Rows of blocks in order; what the block hands down is on its first row only."""
    up = above.select(F.col("tree").alias("of"), F.col("at").alias("over"), *PASSED)
    first = rows.where(F.col("at") % size == 0)
    first = first.join(up, (first["tree"] == up["of"]) & (F.floor(first["at"] / size) == up["over"]), "left").drop("of", "over")
    rest = rows.where(F.col("at") % size != 0)
    for c in PASSED:
        rest = rest.withColumn(c, F.lit(None).cast(up.schema[c].dataType))
    return _blocks(first.unionByName(rest), size)


def block_witnesses(rows: DataFrame, above: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``tree, at`` and what is handed down, of nodes, given that of their blocks (``above``)."""

    def run(batches):
        names = ["tree", "at", *PASSED]
        for (tree, _), members in _streams(batches, ["at", "n", "value", *PASSED]):
            made = _appended([m[2] for m in members], members[0][1], fanout, levels)[0]
            _, _, _, upper, subroot, root = members[0]
            found = [[{"left": a, "right": b} for a, b in made.witness(i)] + (upper or []) for i in range(len(members))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree] * len(members), pa.int64()), pa.array([m[0] for m in members], pa.int64()), pa.array(found, WITNESS_TYPE),
                 *[pa.array([x] * len(members), pa.string()) for x in (subroot, root)]], names
            )

    schema = f"tree long, at long, witness {WITNESS}, subroot string, root string"
    return _with_above(rows, above, fanout**levels).mapInArrow(run, schema)


def proofs(rows: DataFrame, above: DataFrame, fanout: int, levels: int) -> DataFrame:
    """The result's columns of leaves ``tree, at, n, id, source, value, other``, given what their blocks hand down."""

    def run(batches):
        names = ["id", "source", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
        kinds = None

        def typed(stream):
            nonlocal kinds
            for batch in stream:
                kinds = [batch.schema.field("id").type, *[pa.string()] * 6]
                yield batch

        for _, members in _streams(typed(batches), ["id", "source", "n", "value", "other", *PASSED]):
            made = _appended([m[3] for m in members], members[0][2], fanout, levels)[0]
            upper, subroot, root = members[0][5:]
            upper = [(w["left"], w["right"]) for w in upper or ()]
            tail = "".join(a + b for a, b in upper)
            out = []
            for i, (id_, source, _, value, other, *_) in enumerate(members):
                own = made.witness(i)
                proof = digest("".join(a + b for a, b in own) + tail)
                out.append((id_, source, value, subroot, root, proof, fold(other or value, own + upper)))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, source string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    return _with_above(rows, above, fanout**levels).mapInArrow(run, schema)


@dataclass
class Forest:
    """Trees by rounds: ``tables[0]`` their leaves (``tree, at, n, value``), each next one the block roots, the last one row a tree."""

    tables: list[DataFrame]
    fanout: int
    levels: int

    @classmethod
    def build(cls, rows: DataFrame, fanout: int, levels: int) -> Forest:
        tables = [rows]
        while True:
            tables.append(cut(block_roots(tables[-1], fanout, levels), "merkle-roots"))
            if tables[-1].where("n > 1").isEmpty():
                return cls(tables, fanout, levels)

    @property
    def roots(self) -> DataFrame:
        return self.tables[-1].select("tree", "at", "value")

    def handed_down(self, roots: DataFrame, to: int) -> DataFrame:
        """What the nodes of ``tables[to]`` get, given what the roots get (``tree, at`` and ``PASSED``)."""
        found = roots
        for table in reversed(self.tables[to:-1]):
            found = cut(block_witnesses(table, found, self.fanout, self.levels), "merkle-witnesses")
        return found


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    fanout: int = FANOUT,
    levels: int = LEVELS,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """``id, source, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    ``proof_sha256`` is the hash of all siblings up to ``root``; ``folded_root``
    is what they give with the leaf of the row as found at checking (its
    tampered form, see ``tampered_text``).  Null ids come first, null sources
    are one tree and come first.  Repeated ids follow their digest; equal rows
    have leaves of their own.  Null fields are hashed as such, texts whole;
    empty tables give empty results; columns outside ``fields`` are not read.
    """
    found = numbered(cut(leaves(docs, fields, id_col, source_col, text_col), "merkle-leaves"), "source", ["id", "value"])
    # A number stands for the source: 0, 1, ... in order.
    sources = numbered(found.select("source").distinct().withColumn("all", F.lit(0)), "all", ["source"])
    sources = cut(sources.select(F.col("source").alias("name"), F.col("at").alias("tree"), F.col("n").alias("sources")), "merkle-sources")
    rows = found.join(bounded_broadcast(sources), F.col("source").eqNullSafe(F.col("name")))
    rows = cut(rows.select("tree", "at", "n", "id", "source", "value", "other"), "merkle-rows")
    forest = Forest.build(rows.select("tree", "at", "n", "value"), fanout, levels)
    subroots = forest.roots.join(sources, "tree").select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), F.col("sources").alias("n"), "value"
    )
    subroots = cut(subroots, "merkle-subroots")
    top = Forest.build(subroots, fanout, levels)
    none = F.lit(None).cast(WITNESS).alias("witness")
    root = top.roots.select("tree", "at", none, F.lit(None).cast("string").alias("subroot"), F.col("value").alias("root"))
    over = top.handed_down(root, 0).drop("tree", "subroot").withColumnRenamed("at", "tree")
    over = over.join(forest.roots.withColumnRenamed("value", "subroot"), "tree").select("tree", "at", *PASSED)
    proved = proofs(rows, forest.handed_down(over, 1), fanout, levels)
    return proved.select(
        F.col("id").alias(id_col), "source", "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
