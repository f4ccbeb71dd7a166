"""Mixing sources to target weights: temperature, bisection, budgeted block permutations.

1. Token shares s of the sources are raised to an exponent: w = s^a / sum(s^a). Exponent 1 keeps the
   natural shares, 0 makes all sources equal.
2. The exponent is bisected until the weights meet a target: an entropy in nats, or a largest number
   of repetitions, counted against the source that is repeated least. Both fall as the exponent rises.
   Each round halves the interval five times at once, over a grid joined to the table of sources.
3. A source gets `quota` = w * budget tokens. Its documents are dealt to blocks by hash; an epoch is a
   permutation of the blocks and of the documents in each block, keyed by seed and epoch. `start` is a
   draw's place in its source's stream of tokens, and the draws that start before the quota are the
   mixture: full epochs, then a part of one.

Only documents within a block, blocks within a shard of their keys, and the 4,096 shards of an epoch are ever
numbered in one group, so a source that holds a third of all rows is many groups. The table of sources has a row per source; Spark checks its size
before it broadcasts it. Everything is DataFrame code.

Defined cases: a null source is a source; texts of any length count whole; draws whose hashes tie go by id; a
null text counts as empty, and each document counts one
token for its end, so an empty one is drawn too. Rows that repeat source and id are one unit, drawn
together. An empty table gives an empty mixture. Without a budget the smallest one is taken that draws
every document at least once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, text_of
from tidemark.scratch import store

#: Rounds of five halvings each: an exponent within 2^-40.
ROUNDS, HALVINGS = 8, 5

#: Hexadecimal digits of a block's key that name its shard: 4,096 shards an epoch.
SHARD_DIGITS = 3


def word_tokens(text_col: str = "text") -> Column:
    """Words between ASCII white space, and one for the end."""
    return F.regexp_count(text_of(text_col), F.lit(r"[^\x20\x09-\x0D]+")).cast("long") + 1


def weights(
    sizes: DataFrame,
    max_repeats: float | None = None,
    entropy: float | None = None,
    budget: int | None = None,
) -> DataFrame:
    """Adds alpha, weight and quota to a table of sources with a column `tokens`."""
    if (max_repeats is None) == (entropy is None):
        raise ValueError("give max_repeats or entropy")
    low, high = 0.0, 1.0
    parts = 2**HALVINGS
    for _ in range(ROUNDS):
        step = (high - low) / parts
        grid = F.explode(F.array([F.lit(low + step * i) for i in range(1, parts)])).alias("alpha")
        raised = F.pow(F.col("tokens").cast("double"), F.col("alpha"))
        at = (
            sizes.select("tokens", grid)
            .groupBy("alpha")
            .agg(
                F.sum(raised).alias("z"),
                F.sum(raised * F.col("alpha") * F.log("tokens")).alias("u"),
                F.max(F.col("tokens") / raised).alias("most"),
                F.min(F.col("tokens") / raised).alias("least"),
            )
        )
        # log z - u/z is the entropy; tokens/raised is inverse to a source's repetitions
        if entropy is not None:
            too_flat = F.log("z") - F.col("u") / F.col("z") > entropy
        else:
            too_flat = F.col("most") / F.col("least") > max_repeats
        edge = at.where(too_flat).agg(F.max("alpha")).first()[0]
        low = low if edge is None else edge
        high = min(high, low + step)
    alpha = F.lit(high)
    everything = Window.partitionBy(F.lit(0))
    raised = F.pow(F.col("tokens").cast("double"), alpha)
    weight = raised / F.sum(raised).over(everything)
    with_weight = sizes.withColumns({"alpha": alpha, "weight": weight})
    if budget is None:
        needed = F.max(F.col("tokens") / F.col("weight")).over(everything)
        quota = F.greatest(F.floor(F.col("weight") * needed), F.col("tokens"))
    else:
        quota = F.floor(F.col("weight") * budget)
    return with_weight.withColumn("quota", quota.cast("long"))


def key(*parts) -> Column:
    """A pseudo-random order that any engine can repeat: MD5 of the parts joined by colons."""
    return F.md5(F.concat_ws(":", *(p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts)))


def mix(
    docs: DataFrame,
    tokens: Column | None = None,
    max_repeats: float | None = None,
    entropy: float | None = None,
    budget: int | None = None,
    seed: int = 0,
    block_docs: int = 256,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """The mixture, a row per draw: source, id, epoch, block, tokens, start, quota, weight, alpha."""
    tokens = word_tokens() if tokens is None else tokens
    units = docs.select(
        F.col(source_col).alias("source"), F.col(id_col).alias("id"), tokens.alias("tokens")
    )
    units = units.groupBy("source", "id").agg(F.sum("tokens").alias("tokens"))
    units, _ = store(units, "units")
    sizes = units.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs"))
    sizes, _ = store(sizes, "sources")
    sources, _ = store(weights(sizes, max_repeats, entropy, budget), "weights")
    per_source = sources.select(
        F.col("source").alias("of"),
        F.ceil(F.col("docs") / block_docs).alias("blocks"),
        F.col("tokens").alias("total"),
        F.greatest(F.ceil(F.col("quota") / F.col("tokens")), F.lit(0)).cast("int").alias("epochs"),
        "quota",
        "weight",
        "alpha",
    )
    number = F.conv(F.substring(key(seed, F.col("id")), 1, 8), 16, 10).cast("long")
    dealt = units.join(per_source, F.col("source").eqNullSafe(F.col("of"))).withColumn(
        "block", number % F.col("blocks")
    )
    blocks = dealt.groupBy("source", "block", "epochs").agg(F.sum("tokens").alias("block_tokens"))
    epoch = F.explode(F.sequence(F.lit(0), F.col("epochs") - 1)).alias("epoch")
    some = F.col("epochs") > 0
    order = key(seed, F.col("epoch"), F.col("block"))
    ranked = blocks.where(some).select("source", "block", "block_tokens", epoch).withColumn("order", order)
    ranked, _ = store(ranked.withColumn("shard", F.substring("order", 1, SHARD_DIGITS)), "blocks")
    # blocks are put in a row shard by shard of their key, so that no source is numbered in one group
    in_epoch = Window.partitionBy("source", "epoch").orderBy("shard")
    shards = ranked.groupBy("source", "epoch", "shard").agg(F.sum("block_tokens").alias("shard_tokens")).select(
        F.col("source").alias("of_source"),
        F.col("epoch").alias("of_epoch"),
        F.col("shard").alias("of_shard"),
        (F.sum("shard_tokens").over(in_epoch) - F.col("shard_tokens")).alias("shard_start"),
    )
    in_shard = Window.partitionBy("source", "epoch", "shard").orderBy("order", "block")
    before = F.sum("block_tokens").over(in_shard) - F.col("block_tokens")
    in_row = ranked.withColumn("before", before).join(
        shards,
        F.col("source").eqNullSafe(F.col("of_source"))
        & (F.col("epoch") == F.col("of_epoch"))
        & (F.col("shard") == F.col("of_shard")),
    )
    offsets = in_row.select(
        F.col("source").alias("of_"),
        F.col("block").alias("block_"),
        F.col("epoch").alias("epoch_"),
        (F.col("shard_start") + F.col("before")).alias("block_start"),
    )
    in_block = Window.partitionBy("source", "block", "epoch").orderBy(
        key(seed, F.col("epoch"), F.col("id")), "id"
    )
    draws = dealt.where(some).select("*", epoch).withColumn(
        "doc_start", F.sum("tokens").over(in_block) - F.col("tokens")
    )
    same = (
        F.col("source").eqNullSafe(F.col("of_"))
        & (F.col("block") == F.col("block_"))
        & (F.col("epoch") == F.col("epoch_"))
    )
    start = F.col("epoch") * F.col("total") + F.col("block_start") + F.col("doc_start")
    return (
        draws.join(offsets, same)
        .withColumn("start", start)
        .where(F.col("start") < F.col("quota"))
        .select("source", "id", "epoch", "block", "tokens", "start", "quota", "weight", "alpha")
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", **how) -> DataFrame:
    """The documents as often as the mixture draws them, all columns as they are."""
    drawn = mix(docs, id_col=id_col, source_col=source_col, **how)
    of, drawn_id, times = (free_name(docs, n) for n in ("mix_source", "mix_id", "mix_times"))
    drawn = drawn.groupBy(F.col("source").alias(of), F.col("id").alias(drawn_id)).agg(
        F.count("*").cast("int").alias(times)
    )
    same = F.col(source_col).eqNullSafe(F.col(of)) & F.col(id_col).eqNullSafe(F.col(drawn_id))
    repeat = F.explode(F.array_repeat(F.lit(0), F.col(times))).alias(times + "_")
    return docs.join(drawn, same).select(*docs.columns, repeat).select(docs.columns)
