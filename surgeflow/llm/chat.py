"""Cumulative-snapshot collapse of logged conversations, then rendering (DataFrame functions only).

A log that writes a conversation after every turn holds all its prefixes.  Every turn gets the
rolling hash of the turns up to it; a conversation whose whole hash is a proper prefix hash of
a longer one is a snapshot.  Prefix hashes are collapsed before they are shuffled to the
anti-join, so a first turn that a third of all conversations share is one row per map task.

The rolling hash is the XOR of position-bound turn hashes (two of 64 bits), so it needs no
sequential pass: rows are range-partitioned by (conversation, turn), summed inside a range, and
the few totals of a conversation that spans ranges are carried over.  A conversation that
holds a third of all rows is thereby split over many tasks; its text is rendered in chunks of
``CHUNK_TURNS`` turns, one row each.

Edge cases: turns are ordered by (turn, role, text), nulls first, so ties and repeated turns
have a defined order and null turn numbers come first; null role or text differ from empty
ones in the hash and render as empty; rows without conv_id are one conversation; of equal
conversations the smallest conv_id stays; an empty table gives an empty result; other columns
are not read.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

CHUNK_TURNS = 256
SEEDS = (17, 4711)


def rolling_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, pos, h0, h1): place and prefix hashes of every turn."""
    spark = turns.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = turns.select("conv_id", "turn", "role", "text")
    # the range of a row is written down once: a second evaluation could cut elsewhere
    ranged = stage(rows.repartitionByRange(n, "conv_id", "turn", "role", "text")
                   .withColumn("range", F.spark_partition_id()), "chat-ranges")
    inside = Window.partitionBy("range", "conv_id").orderBy("turn", "role", "text")
    placed = ranged.withColumn("n", F.row_number().over(inside))
    sizes = ranged.groupBy("conv_id", "range").agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("conv_id", "range", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start"))

    def same(left: DataFrame, right: DataFrame) -> Column:
        return (left["range"] == right["range"]) & left["conv_id"].eqNullSafe(right["conv_id"])

    placed = placed.join(starts, same(placed, starts)).select(
        placed["conv_id"], "turn", "role", "text", placed["range"], (F.col("n") + F.col("start")).alias("pos"))
    for k, seed in enumerate(SEEDS):
        placed = placed.withColumn(f"t{k}", F.xxhash64(F.lit(seed), "pos", F.col("role").isNull(), "role",
                                                       F.col("text").isNull(), "text"))
    placed = stage(placed, "chat-turns")
    totals = placed.groupBy("conv_id", "range").agg(*[F.bit_xor(f"t{k}").alias(f"s{k}") for k in range(len(SEEDS))])
    carried = totals.select("conv_id", "range", *[F.coalesce(F.bit_xor(f"s{k}").over(earlier), F.lit(0)).alias(f"c{k}")
                                                  for k in range(len(SEEDS))])
    running = Window.partitionBy("range", "conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.select("*", *[F.bit_xor(f"t{k}").over(running).alias(f"r{k}") for k in range(len(SEEDS))])
    return summed.join(carried, same(summed, carried)).select(
        summed["conv_id"], "turn", "role", "text", "pos",
        *[F.col(f"r{k}").bitwiseXOR(F.col(f"c{k}")).alias(f"h{k}") for k in range(len(SEEDS))])


def conversations_of(hashed: DataFrame) -> DataFrame:
    """(conv_id, n_turns, h0, h1, kept): maximal conversations, the first of equal ones."""
    whole = hashed.groupBy("conv_id").agg(
        F.max("pos").alias("n_turns"),
        *[F.max_by(f"h{k}", "pos").alias(f"h{k}") for k in range(len(SEEDS))])
    whole = stage(whole, "chat-whole")
    lengths = whole.select(F.col("conv_id").alias("c"), "n_turns")
    proper = (hashed.join(lengths, hashed["conv_id"].eqNullSafe(lengths["c"])).where(F.col("pos") < F.col("n_turns"))
              .select(F.col("pos").alias("n_turns"), "h0", "h1").distinct())
    keys = ["n_turns", "h0", "h1"]
    first = whole.groupBy(*keys).agg(F.min("conv_id").alias("first"))
    maximal = first.join(proper, keys, "left_anti").withColumn("maximal", F.lit(True))
    return whole.join(first, keys).join(maximal.drop("first"), keys, "left").select(
        "conv_id", "n_turns", "h0", "h1",
        (F.coalesce("maximal", F.lit(False)) & F.col("conv_id").eqNullSafe(F.col("first"))).alias("kept"))


def rendered_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("\n"))


def collapse(turns: DataFrame, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """Rendered maximal conversations: (conv_id, chunk, n_turns, first_turn, text), one row per
    ``chunk_turns`` turns of a conversation."""
    hashed = stage(rolling_hashes(turns), "chat-hashed")
    kept = conversations_of(hashed).where("kept").select(F.col("conv_id").alias("kept_id"), "n_turns")
    # a prefix has no more rows than its conversation: join the kept ids, then gather by chunk
    rows = hashed.join(kept, hashed["conv_id"].eqNullSafe(kept["kept_id"])).select(
        "conv_id", "n_turns", F.floor((F.col("pos") - 1) / chunk_turns).alias("chunk"), "pos",
        rendered_turn(F.col("role"), F.col("text")).alias("part"))
    gathered = rows.groupBy("conv_id", "n_turns", "chunk").agg(
        F.min("pos").alias("first_turn"), F.sort_array(F.collect_list(F.struct("pos", "part"))).alias("parts"))
    return gathered.select("conv_id", "chunk", F.col("n_turns").cast("long").alias("n_turns"),
                           F.col("first_turn").cast("long").alias("first_turn"),
                           F.array_join(F.col("parts.part"), "").alias("text"))
