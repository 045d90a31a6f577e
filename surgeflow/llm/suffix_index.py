"""Removal of long repeated passages with a logarithmic family of sparse suffix indexes.

A byte goes if it lies in a ``LENGTH``-byte string that also starts anywhere else.  Every such
string owns one sampled suffix (its anchor): the least hashed ``GRAM``-gram among its first
``LENGTH - CONTEXT + 1`` places, so equal strings have equal anchors and the suffix at the
anchor shares at least ``CONTEXT`` bytes.  A batch's index is the sorted table of its sampled
suffixes' fingerprints (``CONTEXT`` bytes).  A new batch is merge-scanned against the levels;
suffixes found there (or twice in the batch) are repeated.  Levels of equal size merge, so
there are logarithmically many.  The tables hold one row per distinct suffix (map-side
combine), so a passage that a third of all documents hold is one row.

Repeated suffixes are then judged exactly: the strings an anchor owns are one stretch of text;
stretches that occur twice are removed whole; for one that occurs once while its anchor has
others, its strings are compared with those of the others.  The suffix order is that of
fingerprints, not of letters: equality is all the scan needs.

Edge cases: null and empty texts are zero bytes and keep the hash of nothing; texts shorter
than ``LENGTH`` lose nothing; repeated rows are documents of their own, so their texts repeat;
overlapping repeats in one document count; ids may be null; an empty table gives an empty
result; only ``doc_id`` and ``text`` are read.
"""
from __future__ import annotations

import hashlib
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, map_batches, mix, scratch_path, stage

LENGTH, CONTEXT, GRAM = 400, 160, 16
#: Places per numpy slice, batches of a whole table, runs of a level that merge.
SLICE, BATCHES, FAN_IN = 1 << 21, 3, 2
#: Distinct stretches of one anchor compared in one task; more are shuffled by string hash.
GROUP = 4096


def anchors(text: np.ndarray, length: int, context: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first, last) for runs of starts p, in order, of the ``length``-byte strings of
    ``text`` (uint8) that share an anchor."""
    out: list[tuple[np.ndarray, ...]] = []
    width = length - context + 1
    starts = len(text) - length + 1
    for lo in range(0, max(0, starts), SLICE):
        n = min(SLICE, starts - lo)
        part = text[lo:lo + n + length - 1]
        m = n + width - 1  # gram places that the strings look at
        words = np.lib.stride_tricks.as_strided(part, (m + 8, 8), (1, 1))
        words = np.ascontiguousarray(words).view("<u8").ravel()
        hashed = mix(words[:m] * np.uint64(0x9FB21C651E98DF25) + mix(words[8:m + 8]))
        keys = (hashed & ~np.uint64((1 << 24) - 1)) | np.arange(m, dtype=np.uint64)
        padded = np.full(-(-m // width) * width, np.iinfo(np.uint64).max, np.uint64)
        padded[:m] = keys
        blocks = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = (np.minimum(back[:n], ahead[width - 1:width - 1 + n]) & np.uint64((1 << 24) - 1)).astype(np.int64)
        cut = np.flatnonzero(np.diff(least)) + 1
        first = np.concatenate(([0], cut))
        out.append((least[first] + lo, first + lo, np.concatenate((cut, [n])) - 1 + lo))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(c) for c in zip(*out))


def sampled_suffixes(docs: DataFrame, length: int = LENGTH, context: int = CONTEXT) -> DataFrame:
    """(row, suffix, stretch, first, last, anchor): one row per run of starts with one anchor."""
    names = ["row", "suffix", "stretch", "first", "last", "anchor"]

    def sample(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, places, suffix, stretch = [], [], [], []
        for row, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
            if len(text) < length:
                continue
            at, first, last = anchors(np.frombuffer(text, np.uint8), length, context)
            view = memoryview(text)
            rows.append(np.full(len(at), row, np.int64))
            places.append(np.stack((first, last, at)))
            hash64 = xxhash.xxh3_64_intdigest
            for s, a, b in zip(at.tolist(), first.tolist(), last.tolist()):
                suffix.append(hash64(view[s:s + context]))
                stretch.append(hash64(view[a:b + length], seed=s - a + 1))
        rows = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        first, last, at = np.concatenate(places, axis=1) if places else np.zeros((3, 0), np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(rows), *[pa.array(np.array(x, np.uint64).view(np.int64)) for x in (suffix, stretch)],
             *[pa.array(x.astype(np.int32)) for x in (first, last, at)]], names)

    return map_batches(docs.select("row", "text"), sample,
                       "row long, suffix long, stretch long, first int, last int, anchor int")


class SuffixIndexes:
    """The levels: sorted tables of distinct suffix fingerprints."""

    def __init__(self, spark: SparkSession, fan_in: int = FAN_IN):
        self.spark, self.fan_in = spark, fan_in
        self.levels: list[list[DataFrame]] = []

    def add(self, suffixes: DataFrame) -> DataFrame:
        """Merge-scan a batch (column ``suffix``) against the levels, then add its index.

        Returns the batch's suffixes that are repeated so far."""
        batch = stage(suffixes.groupBy("suffix").agg((F.count(F.lit(1)) > 1).alias("twice"))
                      .repartition("suffix").sortWithinPartitions("suffix"), "suffix-run")
        found = batch.where("twice").select("suffix")
        for level in self.levels:
            for run in level:
                found = found.unionByName(batch.join(run, "suffix", "left_semi").select("suffix"))
        self._put(0, batch.select("suffix"))
        return stage(found, "suffix-found")

    def _put(self, level: int, run: DataFrame) -> None:
        if len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fan_in:
            full, self.levels[level] = self.levels[level], []
            merged = full[0]
            for other in full[1:]:
                merged = merged.unionByName(other)
            self._put(level + 1, stage(merged.distinct().repartition("suffix").sortWithinPartitions("suffix"),
                                       f"suffix-level-{level + 1}"))


def bucketed(docs: DataFrame) -> DataFrame:
    """The texts as a table bucketed by ``row``: shuffled once, then joined without a shuffle."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"texts_{uuid.uuid4().hex}"
    numbered = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    (numbered.repartition(n, "row").write.option("compression", "zstd").option("path", scratch_path(spark, "texts"))
     .bucketBy(n, "row").saveAsTable(name))
    return spark.table(name)


def _extent(strings: list[list[bytes]], offsets: list[list[int]]) -> list[tuple[int, int] | None]:
    """For each member, least and greatest offset of its strings that another member holds too."""
    held = Counter(s for member in strings for s in set(member))
    out: list[tuple[int, int] | None] = []
    for member, places in zip(strings, offsets):
        hit = [p for s, p in zip(member, places) if held[s] > 1]
        out.append((min(hit), max(hit)) if hit else None)
    return out


def _compared(fetched: DataFrame, length: int) -> DataFrame:
    """(row, first, last) of repeated strings among the stretches of each anchor, group by group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[dict] = []

        def judged() -> Iterator[dict]:
            # strings at different distances from the anchor are different keys
            strings, offsets = [], []
            for m in group:
                text, n = memoryview(m["region"]), m["last"] - m["first"] + 1
                strings.append([xxhash.xxh3_128_digest(text[k:k + length], seed=m["anchor"] - m["first"] - k + 1)
                                for k in range(n)])
                offsets.append(list(range(n)))
            for m, hit in zip(group, _extent(strings, offsets)):
                if hit and m["n"] == 1:
                    yield {"row": m["row"], "first": m["first"] + hit[0], "last": m["first"] + hit[1]}

        schema = pa.schema([("row", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])
        for batch in batches:
            found = []
            for m in batch.to_pylist():
                if group and group[0]["suffix"] != m["suffix"]:
                    found += judged()
                    group.clear()
                group.append(m)
            yield pa.RecordBatch.from_pylist(found, schema=schema)
        if group:
            yield pa.RecordBatch.from_pylist(list(judged()), schema=schema)

    return fetched.repartition("suffix").sortWithinPartitions("suffix").mapInArrow(run, "row long, first int, last int")


def _shuffled(fetched: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many stretches: strings are counted by hash, split over tasks."""
    names = ["row", "first", "n", "place", "key_a", "key_b", "suffix"]

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for m in batch.to_pylist():
                text, n = memoryview(m["region"]), m["last"] - m["first"] + 1
                keys = b"".join(xxhash.xxh3_128_digest(text[k:k + length], seed=m["anchor"] - m["first"] - k + 1)
                                for k in range(n))
                both = np.frombuffer(keys, "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, m["row"], np.int64)), pa.array(np.full(n, m["first"], np.int32)),
                     pa.array(np.full(n, m["n"], np.int64)), pa.array(m["first"] + np.arange(n, dtype=np.int32), pa.int32()),
                     pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()),
                     pa.array(np.full(n, m["suffix"], np.int64))], names)

    made = fetched.mapInArrow(strings, "row long, first int, n long, place int, key_a long, key_b long, suffix long")
    keys = ["suffix", "key_a", "key_b"]
    twice = made.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(*keys)
    return (made.where("n = 1").join(twice, keys, "left_semi").groupBy("row", F.col("first").alias("f"))
            .agg(F.min("place").alias("first"), F.max("place").alias("last")).select("row", "first", "last"))


def repeated_ranges(texts: DataFrame, length: int = LENGTH, context: int = CONTEXT, batches: int = BATCHES,
                    group: int = GROUP) -> DataFrame:
    """(row, first, last): runs of starts of repeated strings (some twice)."""
    batch = F.pmod(F.xxhash64("row"), F.lit(batches))
    places = stage(sampled_suffixes(texts, length, context).withColumn("batch", batch), "suffixes", ["batch"])
    index, repeated = SuffixIndexes(texts.sparkSession), None
    for k in range(batches):
        found = index.add(places.where(F.col("batch") == k).select("suffix"))
        repeated = found if repeated is None else repeated.unionByName(found)
    hits = stage(places.drop("batch").join(repeated.distinct(), "suffix"), "suffix-hits")
    member = F.struct("row", "first", "last", "anchor")
    kinds = stage(hits.groupBy("suffix", "stretch").agg(F.count(F.lit(1)).alias("n"), F.min(member).alias("m")),
                  "stretches")
    whole = hits.join(kinds.where("n > 1").select("suffix", "stretch"), ["suffix", "stretch"], "left_semi")
    mixed = kinds.groupBy("suffix").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least")).where(
        "kinds > 1 and least = 1")
    wanted = kinds.join(mixed.select("suffix", "kinds"), "suffix").select(
        F.col("m.row").alias("row"), F.struct("suffix", "m.first", "m.last", "m.anchor", "n", "kinds").alias("want"))
    wanted = wanted.groupBy("row").agg(F.collect_list("want").alias("wants"))
    names = ["row", "suffix", "first", "last", "anchor", "n", "kinds", "region"]

    def fetch(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for row, text, wants in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), batch.column(2).to_pylist()):
            rows += [(row, *(w[k] for k in names[1:-1]), text[w["first"]:w["last"] + length]) for w in wants]
        kinds_ = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds_)], names)

    fetched = stage(map_batches(
        texts.join(wanted.hint("shuffle_hash"), "row").select("row", "text", "wants"), fetch,
        "row long, suffix long, first int, last int, anchor int, n long, kinds long, region binary"), "stretch-texts")
    small, large = fetched.where(F.col("kinds") <= group), fetched.where(F.col("kinds") > group)
    return (whole.select("row", "first", "last").unionByName(_compared(small, length))
            .unionByName(_shuffled(large, length)))


def remove_repeats(docs: DataFrame, length: int = LENGTH, context: int = CONTEXT, batches: int = BATCHES,
                   group: int = GROUP) -> DataFrame:
    """One row per document: ``doc_id``, ``kept`` (remaining bytes), ``n_bytes``, ``n_removed``,
    ``n_spans`` and ``kept_sha256``."""
    texts = bucketed(docs)
    ranges = repeated_ranges(texts, length, context, batches, group).groupBy("row").agg(
        F.collect_list(F.struct("first", "last")).alias("ranges"))
    schema = T.StructType([docs.schema["doc_id"], T.StructField("kept", T.BinaryType()),
                           *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")],
                           T.StructField("kept_sha256", T.StringType())])

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, numbers, digests = [], [], []
        for text, found in zip(as_bytes(batch.column(1)), batch.column(2)):
            removed = spans = 0
            if found.is_valid:
                pairs = found.values
                pairs = np.stack([f.to_numpy(zero_copy_only=False).astype(np.int64) for f in pairs.flatten()], axis=1)
                pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
                ends = np.maximum.accumulate(pairs[:, 1] + length)
                new = np.flatnonzero(np.r_[True, pairs[1:, 0] > ends[:-1]])
                begin, end = pairs[new, 0], ends[np.r_[new[1:] - 1, len(ends) - 1]]
                left = np.r_[0, end], np.r_[begin, len(text)]
                removed, spans = int((end - begin).sum()), len(new)
                text = b"".join(text[a:b] for a, b in zip(*(x.tolist() for x in left)))
            kept.append(text)
            numbers.append((len(text) + removed, removed, spans))
            digests.append(hashlib.sha256(text).hexdigest())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary()),
                                           *[pa.array(c, pa.int64()) for c in zip(*numbers)], pa.array(digests)],
                                          [f.name for f in schema])

    joined = texts.join(ranges.hint("shuffle_hash"), "row", "left").select("doc_id", "text", "ranges")
    return map_batches(joined, cut, schema)
