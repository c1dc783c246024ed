"""Mixing sources to target weights by Sainte-Laguë apportionment.

All of it is DataFrame work; no Python runs on the executors.

1. *Targets*: the tokens of the mix are shared among sources by weight; no
   target exceeds ``max_epochs`` times its source, the excess is reshared by
   weight (water filling over the source table).
2. *Quotas*: the mix is cut into units of equal tokens, and units go to
   sources by the highest quotients ``target / (2 k + 1)``.  A source's units
   go to its shards in the same way, by shard size.  A shard holds a bounded
   number of tokens, so a source with a third of all rows is many shards.  A
   unit is one token unless said otherwise, so that the smallest source too
   gets its target; only about one row per source or shard is ranked, however
   many units there are.
3. *Selection*: a shard is its documents in a seeded order, one stream of
   tokens.  It is taken whole as often as its quota allows; the rest are
   blocks of the stream in a second seeded order, the last one in part.

The windows over documents and blocks are per shard; those over the source
table and over a source's shards see one row per source and shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.stage import cut

WORDS = r"[^\x20\x09-\x0D]+"


def seeded(seed: int, *parts):
    """Order key: md5 of the seed and the parts."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def sainte_lague(df: DataFrame, group: list[str], key: str, votes: str, seats: str) -> DataFrame:
    """``quota`` for every row: ``seats`` of its group by highest quotients.

    Quotients at the divisors of ``seats`` less and plus half the group's rows
    bracket the result, so only about one row per member and open seat is
    ranked.  Equal quotients go to the smaller ``key``.
    """
    per = Window.partitionBy(*group)
    k, total = F.count("*").over(per), F.sum(votes).over(per)
    bracket = df.withColumn("__k", k).withColumn("__v", total)
    at = lambda sign: F.floor(
        F.col(votes).cast("double") * (2 * F.col(seats) + sign * F.col("__k")) / (2 * F.col("__v")) + 0.5
    )
    bracket = bracket.withColumn("__lo", F.when(F.col("__v") > 0, F.greatest(at(-1), F.lit(0))).otherwise(0).cast("long"))
    bracket = bracket.withColumn("__hi", F.when(F.col("__v") > 0, at(1)).otherwise(0).cast("long"))
    opened = bracket.withColumn("__open", F.col(seats) - F.sum("__lo").over(per))
    asked = opened.where((F.col("__hi") > F.col("__lo")) & (F.col("__open") > 0)).select(
        *group, key, "__open",
        F.explode(F.sequence(F.col("__lo") + 1, F.col("__hi"))).alias("__seat"), F.col(votes).alias("__votes"),
    )
    best = Window.partitionBy(*group).orderBy(F.desc(F.col("__votes") / (2 * F.col("__seat") - 1)), key)
    won = asked.withColumn("__rank", F.row_number().over(best)).where("__rank <= __open").groupBy(*group, key).agg(
        F.count("*").alias("__won")
    )
    return opened.join(won, [*group, key], "left").withColumn(
        "quota", F.col("__lo") + F.coalesce("__won", F.lit(0))
    ).drop("__k", "__v", "__lo", "__hi", "__open", "__won")


def targets(sources: DataFrame, weights: list[int], max_epochs: int) -> DataFrame:
    """``source_no, weight, target`` added to ``source, source_size``."""
    every = Window.orderBy(F.col("source").asc_nulls_last())
    rank = sources.withColumn("source_no", F.row_number().over(every))
    cases = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("source_no") - 1) % len(weights) + 1)
    s = rank.withColumn("weight", cases.cast("long")).withColumn("cap", max_epochs * F.col("source_size"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "source_no").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    s = s.withColumn("total", F.sum("source_size").over(everything)).withColumn("weights", F.sum("weight").over(everything))
    s = s.withColumn("cap_before", F.coalesce(F.sum("cap").over(by_cap), F.lit(0)))
    s = s.withColumn("weight_before", F.coalesce(F.sum("weight").over(by_cap), F.lit(0)))
    full = F.col("cap") * (F.col("weights") - F.col("weight_before")) <= F.col("weight") * (F.col("total") - F.col("cap_before"))
    s = s.withColumn("full", full)
    s = s.withColumn("cap_sum", F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(everything))
    s = s.withColumn("open_weight", F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everything))
    share = (F.col("weight") * (F.col("total") - F.col("cap_sum"))).cast("double") / F.col("open_weight")
    return s.select(
        "source", "source_size", "source_no", "weight", "total",
        F.when(F.col("full"), F.col("cap").cast("double")).otherwise(share).alias("target"),
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    max_epochs: int = 3,
    block_tokens: int = 128,
    unit_tokens: int = 1,
    shard_tokens: int = 1 << 22,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``id, source, size, source_size, target, quota, taken`` of every row.

    Size is the number of ``[^\\x20\\x09-\\x0D]+`` in the text, 0 for null.
    Sources weigh ``weights`` in turn, by code point, null last, and share as
    many tokens as all rows have.  ``taken`` counts tokens with repeats, at most
    ``max_epochs * size``; a source takes ``quota * unit_tokens`` or all it may,
    in blocks of ``block_tokens``.  Reruns agree; rows equal in id, source and size are
    interchangeable.  Null ids and sources are values like others; rows
    without words take part with 0; an empty table gives an empty result.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORDS)), F.lit(0)).cast("long")
    sized = cut(
        docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size")), "sizes"
    )
    sources = cut(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), list(weights), max_epochs), "sources")
    seats = F.round(F.col("total") / unit_tokens).cast("long")
    quotas = sainte_lague(sources.withColumn("seats", seats).withColumn("all", F.lit(0)), ["all"], "source_no", "target", "seats")
    shards_of = F.greatest(F.ceil(F.col("source_size") / shard_tokens), F.lit(1))
    number = F.conv(F.substring(seeded(seed, F.col("id")), 1, 8), 16, 10).cast("long")
    place = sources.select("source_no", F.col("source").alias("s"), shards_of.alias("shards"))
    # One row per source; adaptive execution picks the join by measured size.
    in_shard = sized.join(place, sized["source"].eqNullSafe(place["s"])).select(
        "id", "source", "size", "source_no", F.pmod(number, F.col("shards")).alias("shard")
    )
    stream = Window.partitionBy("source_no", "shard").orderBy(seeded(seed + 1, F.col("id")), F.col("id"), "size").rowsBetween(
        Window.unboundedPreceding, 0
    )
    placed = cut(in_shard.withColumn("end", F.sum("size").over(stream)).withColumn("start", F.col("end") - F.col("size")), "streams")
    shards = placed.groupBy("source_no", "shard").agg(F.sum("size").alias("length")).join(
        quotas.select("source_no", F.col("quota").alias("seats")), "source_no"
    )
    dealt = sainte_lague(shards, ["source_no"], "shard", "length", "seats").where("length > 0")
    tokens = F.least(F.col("quota") * unit_tokens, max_epochs * F.col("length"))
    dealt = dealt.withColumn("tokens", tokens).withColumn("epochs", F.floor(F.col("tokens") / F.col("length")))
    dealt = cut(dealt.withColumn("rest", F.col("tokens") - F.col("epochs") * F.col("length")), "shard-quotas")

    last = F.floor((F.col("length") - 1) / block_tokens)
    blocks = dealt.where("rest > 0").select("source_no", "shard", "length", "rest", F.explode(F.sequence(F.lit(0), last)).alias("block"))
    blocks = blocks.withColumn("tokens", F.least(F.lit(block_tokens), F.col("length") - F.col("block") * block_tokens))
    draw = Window.partitionBy("source_no", "shard").orderBy(
        seeded(seed + 2, F.col("source_no"), F.col("shard"), F.col("block")), "block"
    ).rowsBetween(Window.unboundedPreceding, 0)
    upto = blocks.withColumn("upto", F.sum("tokens").over(draw))
    taken = F.least(F.col("tokens"), F.col("rest") - (F.col("upto") - F.col("tokens")))
    chosen = upto.where("upto - tokens < rest").select("source_no", "shard", "block", taken.alias("part"))

    # A document's part of every block it lies in.
    lies = placed.where("size > 0").select(
        "source_no", "shard", "start", "end",
        F.explode(F.sequence(F.floor(F.col("start") / block_tokens), F.floor((F.col("end") - 1) / block_tokens))).alias("block"),
    )
    from_ = F.greatest(F.col("start"), F.col("block") * block_tokens)
    to = F.least(F.col("end"), F.col("block") * block_tokens + F.col("part"))
    parts = (
        # The blocks come from few rows by explode, so their estimated size would say broadcast.
        lies.join(chosen.hint("merge"), ["source_no", "shard", "block"])
        .groupBy("source_no", "shard", "start")
        .agg(F.sum(F.greatest(to - from_, F.lit(0))).alias("part"))
    )
    whole = dealt.select("source_no", "shard", "epochs")
    sized_part = placed.join(parts, ["source_no", "shard", "start"], "left").join(whole, ["source_no", "shard"], "left")
    take = F.when(
        F.col("size") > 0, F.col("size") * F.coalesce("epochs", F.lit(0)) + F.coalesce("part", F.lit(0))
    ).otherwise(F.lit(0))
    about = quotas.select("source_no", "source_size", "target", "quota")
    return sized_part.withColumn("taken", take.cast("long")).join(about, "source_no").select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "quota", "taken"
    )
