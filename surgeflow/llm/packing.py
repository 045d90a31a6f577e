"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become pieces of at most ``capacity`` tokens; full pieces are sequences of their
own.  The others are dealt by hash into shards of about ``SHARD`` pieces.  Every shard is a
packing problem solved on ``ISLANDS`` islands: an individual is a list of bins; crossover
injects the fullest bins of one parent whole, removes the bins of the other parent that hold
a duplicate, and places the displaced pieces best-fit.  After each epoch every island sends
its best individual to the next island of the shard.  Bins left with much slack by all shards
are dissolved and packed again together, as long as that saves sequences.

State is one row per shard and island (piece lengths and bins as integers), so nothing grows
with the corpus but the number of rows, and each epoch's rows are a written table.

Edge cases: null and empty texts are one piece of one token (the end id); repeated and null
ids stay apart by an internal row number; a text of any length gives as many pieces as
needed; an empty table gives no pieces; only ``doc_id`` and ``text`` are read.
"""
from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import default_vocabulary, stage, token_ids

CAPACITY, END_ID = 2048, 0
SHARD, ISLANDS, EPOCHS, GENERATIONS, POPULATION = 6000, 2, 2, 12, 6
#: Share of the capacity that an under-filled bin leaves empty.
SLACK = 0.02


def cut_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(row, doc_id, piece, start, length, ids_crc32): pieces of every document's ids and end id."""
    path, end = vocabulary or default_vocabulary(), np.asarray([END_ID], "<u4").tobytes()
    schema = T.StructType([T.StructField("row", T.LongType()), docs.schema["doc_id"],
                           T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, start, length, crc = [], [], [], []
            for first, ids, bounds in token_ids(path).encode(batch.column(2)):
                for at, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist()), first):
                    whole = ids[a:b].tobytes() + end
                    for k in range(0, len(whole), 4 * capacity):
                        piece = whole[k:k + 4 * capacity]
                        owner.append(at)
                        start.append(k // 4)
                        length.append(len(piece) // 4)
                        crc.append(zlib.crc32(piece))
            owner, start = pa.array(owner, pa.int64()), np.asarray(start, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(owner), batch.column(1).take(owner), pa.array((start // capacity).astype(np.int32)),
                 pa.array(start), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], [f.name for f in schema])

    return docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(cut, schema)


# ------------------------------------------------------------------ one island's bins

Bins = list[list[int]]


def best_fit(pieces: np.ndarray, sizes: list[int], bins: Bins, capacity: int) -> Bins:
    """Place ``pieces`` (in the given order) into the fullest bins that take them."""
    rooms = sorted((capacity - sum(sizes[p] for p in b), i) for i, b in enumerate(bins))
    rooms = [r for r in rooms if r[0] > 0]
    for p in pieces:
        at = bisect_left(rooms, (sizes[p], -1))
        if at < len(rooms):
            room, i = rooms.pop(at)
            bins[i].append(p)
        else:
            room, i = capacity, len(bins)
            bins.append([p])
        if room > sizes[p]:
            insort(rooms, (room - sizes[p], i))
    return bins


def fitness(bins: Bins, sizes: list[int], capacity: int) -> float:
    """Mean squared fill: fewer and unevenly filled bins are better."""
    return sum((sum(sizes[p] for p in b) / capacity) ** 2 for b in bins) / max(1, len(bins))


def crossover(giver: Bins, taker: Bins, sizes: list[int], capacity: int, rng) -> Bins:
    """Inject the giver's well-filled bins whole, drop the taker's bins with duplicates,
    place what they displaced best-fit, largest first (equal sizes in random order)."""
    fill = np.array([sum(sizes[p] for p in b) for b in giver])
    share = rng.uniform(0.3, 0.8)
    order = np.argsort(-fill + rng.uniform(0, 0.01 * capacity, len(fill)), kind="stable")
    child = [list(giver[i]) for i in order[:max(1, int(share * len(order)))]]
    placed = {p for b in child for p in b}
    displaced: list[int] = []
    for b in taker:
        if placed.isdisjoint(b):
            child.append(list(b))
        else:
            displaced += [p for p in b if p not in placed]
    return best_fit(_falling(displaced, sizes, rng), sizes, child, capacity)


def mutate(bins: Bins, sizes: list[int], capacity: int, rng) -> Bins:
    """Dissolve the emptiest bins and some others and place their pieces again."""
    room = np.array([capacity - sum(sizes[p] for p in b) for b in bins])
    odds = room + 0.02 * capacity
    gone = set(rng.choice(len(bins), max(1, len(bins) // 10), replace=False, p=odds / odds.sum()).tolist())
    kept = [b for i, b in enumerate(bins) if i not in gone]
    return best_fit(_falling([p for i in gone for p in bins[i]], sizes, rng), sizes, kept, capacity)


def _falling(pieces: list[int], sizes: list[int], rng, noise: float = 0.0) -> list[int]:
    key = np.array([sizes[p] for p in pieces], float)
    key = key * (1 + rng.uniform(-noise, noise, len(key))) + rng.uniform(0, 0.5, len(key))
    return [pieces[i] for i in np.argsort(-key)]


def evolve(sizes: list[int], population: list[Bins], capacity: int, rng, generations: int, keep: int) -> list[Bins]:
    """``generations`` of crossover and mutation; the best ``keep`` individuals, best first."""
    everything = list(range(len(sizes)))
    noise = (0.0, 0.02, 0.05, 0.1)
    while len(population) < keep:
        order = _falling(everything, sizes, rng, noise[len(population) % len(noise)])
        population.append(best_fit(order, sizes, [], capacity))

    def ranked(b: Bins):
        return (len(b), -fitness(b, sizes, capacity)), b

    # every individual is ranked once, when it is made
    known = sorted(map(ranked, population), key=itemgetter(0))[:keep]
    least = -(-sum(sizes) // capacity)
    for _ in range(generations):
        if len(known[0][1]) <= least:   # no packing has fewer sequences
            break
        a, b = rng.permutation(len(known))[:2] if len(known) > 1 else (0, 0)
        child = crossover(known[a][1], known[b][1], sizes, capacity, rng)
        child = mutate(child, sizes, capacity, rng)
        known = sorted([*known, ranked(child)], key=itemgetter(0))[:keep]
    return [b for _, b in known]


# ------------------------------------------------------------------------- the islands

STATE = "shard long, island int, bins binary"


def _encode(bins: Bins, n: int) -> bytes:
    number = np.empty(n, "<i4")
    for i, b in enumerate(bins):
        number[b] = i
    return number.tobytes()


def _decode(blob: bytes) -> Bins:
    number = np.frombuffer(blob, "<i4")
    order = np.argsort(number, kind="stable")
    return [part.tolist() for part in np.split(order, np.cumsum(np.bincount(number))[:-1])] if len(number) else []


def pack_shards(pieces: DataFrame, capacity: int = CAPACITY, shard: int = SHARD, islands: int = ISLANDS,
                epochs: int = EPOCHS, generations: int = GENERATIONS, seed: int = 0) -> DataFrame:
    """(id, shard, bin) for pieces (id, length): the best individual of every shard."""
    n = pieces.count()
    shards = max(1, -(-n // shard))
    dealt = stage(pieces.select(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(shards)).alias("shard"), "id", "length"),
                  "pack-shards")
    states = dealt.sparkSession.createDataFrame([], STATE)
    each = dealt.withColumn("island", F.explode(F.array([F.lit(i) for i in range(islands)])))
    for epoch in range(epochs):
        def run(items: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
            if not len(items):
                return pd.DataFrame({"shard": [], "island": [], "bins": []})
            key, island = int(items["shard"].iloc[0]), int(items["island"].iloc[0])
            sizes = items.sort_values("id")["length"].tolist()
            rng = np.random.default_rng([seed, epoch, key, island])
            best = evolve(sizes, [_decode(b) for b in sorted(old["bins"])], capacity, rng, generations, POPULATION)
            blobs = [_encode(b, len(sizes)) for b in best]
            # the population stays; the elite also migrates to the next island
            return pd.DataFrame({"shard": key, "island": [island] * len(blobs) + [(island + 1) % islands],
                                 "bins": blobs + blobs[:1]})

        states = stage(each.groupBy("shard", "island").cogroup(states.groupBy("shard", "island"))
                       .applyInPandas(run, STATE), "pack-state")

    def choose(items: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values("id")
        sizes = items["length"].tolist()
        best = min(old["bins"], key=lambda b: (lambda x: (len(x), -fitness(x, sizes, capacity)))(_decode(b)))
        return pd.DataFrame({"id": items["id"], "shard": items["shard"], "bin": np.frombuffer(best, "<i4")})

    return stage(dealt.groupBy("shard").cogroup(states.groupBy("shard")).applyInPandas(
        choose, "id long, shard long, bin int"), "packed")


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, shard: int = SHARD,
         islands: int = ISLANDS, epochs: int = EPOCHS, slack: float = SLACK) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id`` and ``offset`` in the sequence."""
    pieces = stage(cut_documents(docs, vocabulary, capacity).withColumn("id", F.monotonically_increasing_id()), "pieces")
    parts = pieces.where(F.col("length") < capacity).select("id", "length")
    first = pack_shards(parts, capacity, shard, islands, epochs).join(parts, "id")
    room = Window.partitionBy("shard", "bin")
    first = stage(first.withColumn("loose", F.sum("length").over(room) < (1 - slack) * capacity), "packed-first")
    loose = first.where("loose")
    again = pack_shards(loose.select("id", "length"), capacity, shard, islands, epochs, seed=1)
    before = loose.select("shard", "bin").distinct().count()
    # a second packing that saves nothing is left out
    if again.select("shard", "bin").distinct().count() < before:
        bins = first.where(~F.col("loose")).select("id", "shard", "bin", F.lit(0).alias("round")).unionByName(
            again.withColumn("round", F.lit(1)))
    else:
        bins = first.select("id", "shard", "bin", F.lit(0).alias("round"))
    # full pieces have numbers below zero, bins from zero up
    number = (F.col("shard") * 2 + F.col("round")) * F.lit(1 << 20) + F.col("bin")
    placed = pieces.join(bins.select("id", number.alias("sequence_id")), "id", "left").withColumn(
        "sequence_id", F.coalesce("sequence_id", -1 - F.col("id")))
    order = Window.partitionBy("sequence_id").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id",
                         F.coalesce(F.sum("length").over(order), F.lit(0)).cast("long").alias("offset"))
