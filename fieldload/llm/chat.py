"""Chat formatting of reply trees.

Messages point to their parents.  Root-to-leaf paths are enumerated by
self-joins that double their reach (after round ``i`` every leaf holds its
``2**i`` nearest ancestors and every message its ancestor ``2**i`` above), so
a path of depth ``d`` takes about ``log2 d`` rounds.  Branches are ranked by
score, and each chosen path is formatted as one conversation.

Template: ``<|im_start|>role NEWLINE text<|im_end|> NEWLINE`` for each turn.
Inside texts and roles a backslash is doubled and ``<|`` becomes ``<\\|``, so no
control string can occur there and reading back is exact.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.stage import cut

# Fixed values of the template.
START, END = "<|im_start|>", "<|im_end|>\n"
TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)
ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def format_turns(turns: list[tuple[str, str]], learn: str) -> tuple[str, list[tuple[int, int]]]:
    """The conversation's string and the code point ranges of its ``learn`` texts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        if role == learn:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    turns = [(unescape(m[1]), unescape(m[2])) for m in TURN.finditer(formatted)]
    return turns


def paths(messages: DataFrame) -> DataFrame:
    """``tree, leaf, node, up``: every message on the way from a leaf to its root.

    ``messages`` has unique (``tree``, ``node``) without nulls, and ``parent``;
    a parent that does not exist makes a root.  Parents must not form a cycle.
    """
    nodes = messages.select("tree", "node")
    parents = messages.select("tree", "node", F.col("parent").alias("above"))
    jump = cut(
        parents.join(nodes.withColumnRenamed("node", "above"), ["tree", "above"], "left_semi").select("tree", "node", "above"), "parents"
    )
    leaves = nodes.join(jump.select("tree", F.col("above").alias("node")).distinct(), ["tree", "node"], "left_anti")
    walk = cut(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).alias("up")), "walks")
    reach, bound = 1, max(1, nodes.count())
    while not jump.isEmpty():
        if reach > bound:
            raise ValueError("parents form a cycle")
        step = walk.join(jump, ["tree", "node"]).select("tree", "leaf", F.col("above").alias("node"), (F.col("up") + reach).alias("up"))
        walk = cut(walk.unionByName(step), "walks")
        twice = jump.join(jump.select("tree", F.col("node").alias("above"), F.col("above").alias("further")), ["tree", "above"])
        jump = cut(twice.select("tree", "node", F.col("further").alias("above")), "parents")
        reach *= 2
    return walk


def one_of_each(messages: DataFrame) -> DataFrame:
    """Of rows with one (``tree``, ``node``) the least by parent, role, text and score, nulls first."""
    told = F.min(F.struct("parent", "role", "text", "score")).alias("m")
    return messages.groupBy("tree", "node").agg(told).select("tree", "node", "m.*")


def format_trees(messages: DataFrame, learn: str = "assistant", per_tree: int | None = None, unique: bool = False) -> DataFrame:
    """``tree, leaf, branch_score, branch, formatted, spans`` of each root-to-leaf path.

    ``messages`` has ``tree, node, parent, role, text, score``.  Branches of a
    tree are ranked by the mean score of their messages (null scores count 0),
    ties to the smaller leaf; ``per_tree`` keeps that many.  ``spans`` are the
    code point ranges of the texts to learn from.  Null roles and texts read
    as empty.  Of rows that repeat a tree's node one counts (:func:`one_of_each`);
    ``unique`` says that there are none.  An empty table gives an empty result.
    """
    if not unique:
        messages = cut(one_of_each(messages), "messages")
    walk = paths(messages)
    said = messages.select("tree", "node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    marks = messages.select("tree", "node", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    scored = walk.join(marks, ["tree", "node"]).groupBy("tree", "leaf").agg(F.avg("score").alias("branch_score"))
    order = Window.partitionBy("tree").orderBy(F.desc("branch_score"), "leaf")
    chosen = scored.withColumn("branch", F.row_number().over(order))
    if per_tree is not None:
        chosen = chosen.where(F.col("branch") <= per_tree)
    turns = (
        walk.join(chosen, ["tree", "leaf"])
        .join(said, ["tree", "node"])
        .groupBy("tree", "leaf", "branch_score", "branch")
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("up")).alias("at"), "role", "text"))).alias("turns"))
    )

    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            text, spans = [], []
            for turn in batch["turns"].to_pylist():
                made, learned = format_turns([(t["role"], t["text"]) for t in turn], learn)
                text.append(made)
                spans.append([{"start": a, "end": b} for a, b in learned])
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in ("tree", "leaf", "branch_score", "branch")] + [pa.array(text, pa.string()), pa.array(spans, kind)],
                names=["tree", "leaf", "branch_score", "branch", "formatted", "spans"],
            )

    types = {f.name: f.dataType.simpleString() for f in turns.schema}
    return turns.mapInArrow(
        run,
        f"tree {types['tree']}, leaf {types['leaf']}, branch_score double, branch int, formatted string, "
        "spans array<struct<start:int,end:int>>",
    )


def digests(formatted: DataFrame) -> DataFrame:
    """Columns of ``formatted`` but the text, with digests read back from text and spans."""
    kept = [c for c in formatted.columns if c not in ("formatted", "spans")]

    def run(batches):
        for batch in batches:
            out = {"n_turns": [], "turns_sha256": [], "loss_chars": [], "loss_sha256": [], "formatted_chars": []}
            for text, spans in zip(batch["formatted"].to_pylist(), batch["spans"].to_pylist(), strict=True):
                turns = read_turns(text)
                loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
                out["n_turns"].append(len(turns))
                out["turns_sha256"].append(hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest())
                out["loss_chars"].append(len(loss))
                out["loss_sha256"].append(hashlib.sha256(loss.encode()).hexdigest())
                out["formatted_chars"].append(len(text))
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in kept]
                + [pa.array(v, pa.string() if "sha" in c else pa.int64()) for c, v in out.items()],
                names=[*kept, *out],
            )

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in formatted.schema if f.name in kept)
    return formatted.mapInArrow(
        run, types + ", n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def conversation_messages(conversations: DataFrame) -> DataFrame:
    """Rows of conversations as reply chains: each row answers the one before it.

    Rows stand by turn, then role and text, nulls last; rows with a null
    ``conv_id`` are one conversation.  Every message scores 1.
    """
    order = Window.partitionBy("conv_id").orderBy(*[F.col(c).asc_nulls_last() for c in ("turn", "role", "text")])
    at = conversations.select("conv_id", "turn", "role", "text").withColumn("node", F.row_number().over(order).cast("long"))
    # A tree's key is the id as text, so that a null id joins like others.
    tree = F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))
    return at.select(tree.alias("tree"), "node", (F.col("node") - 1).alias("parent"), "role", "text", F.lit(1.0).alias("score"))
