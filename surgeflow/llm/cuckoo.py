"""Exact dedup with a cuckoo-filter index over live digests.

The index is split into ``buckets`` by digest, as many as its keys need: ``BUCKET_KEYS`` is the
most that a bucket holds on average, and when a batch would pass it the buckets are doubled
(or more) and all filters rebuilt from the stored keys, so a task's share stays bounded and
the number of tasks grows with the index.  A bucket has one cuckoo filter (a row with a
16-bit fingerprint table) and its stored keys (rows of the key tables).  A batch of distinct
digests is probed against the filters alone; only hits are verified against the stored keys.
New digests go into the filters and the key tables, deletions take a fingerprint out and
leave a tombstone.  A filter that overflows is rebuilt twice as large from the stored keys.

Copies are collapsed by digest before they reach the index (map-side combine), so a digest
that holds a third of all rows is one row per map task.

Edge cases: null text counts as empty; all empty texts are one group; repeated rows (same id
and text) are one group in which exactly one row stays; a null id loses ties; an empty table
gives an empty result; only ``doc_id`` and ``text`` are read.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stage

#: Fixed value of the task: characters deleted before texts are compared.
BLANKS = " \t\n\u000b\f\r"
#: Mean keys of a bucket at most, first slots of a bucket's filter, batches into which a table is cut.
BUCKET_KEYS, SLOTS, BATCHES = 1 << 14, 2048, 3
WAYS, MAX_KICKS = 4, 200


class CuckooFilter:
    """Fingerprint table of ``rows`` x 4; a key's two rows differ by a hash of its fingerprint."""

    def __init__(self, slots: int = SLOTS, table: np.ndarray | None = None):
        rows = 1 << max(1, (max(slots, WAYS) // WAYS - 1).bit_length())
        self.table = np.zeros((rows, WAYS), np.uint16) if table is None else table

    @property
    def mask(self) -> int:
        return len(self.table) - 1

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint (never 0) and both rows of each 64-bit key."""
        prints = (keys >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        first = (keys & np.uint64(self.mask)).astype(np.int64)
        return prints, first, first ^ self._step(prints)

    def _step(self, prints):
        return (np.asarray(prints).astype(np.int64) * 0x5BD1E995 >> 7) & self.mask

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, a, b = self._places(keys)
        return ((self.table[a] == prints[:, None]) | (self.table[b] == prints[:, None])).any(axis=1)

    def _fill(self, prints: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Put prints into the free cells of their rows, all rows at once; True where one had no room."""
        order = np.argsort(rows, kind="stable")
        sorted_rows = rows[order]
        rank = np.arange(len(rows)) - np.searchsorted(sorted_rows, sorted_rows)
        free = np.sort(np.where(self.table[sorted_rows] == 0, np.arange(WAYS), WAYS), axis=1)
        way = np.where(rank < WAYS, free[np.arange(len(rows)), np.minimum(rank, WAYS - 1)], WAYS)
        ok = way < WAYS
        self.table[sorted_rows[ok], way[ok]] = prints[order[ok]]
        left = np.ones(len(rows), bool)
        left[order[ok]] = False
        return left

    def insert(self, keys: np.ndarray) -> bool:
        """False when a key finds no place; the caller then rebuilds from stored keys."""
        prints, *places = self._places(keys)
        for n in (0, 1):
            left = self._fill(prints, places[n])
            prints, places = prints[left], [p[left] for p in places]
        return all(self._kick(print_, row) for print_, row in zip(prints.tolist(), places[1].tolist()))

    def _kick(self, print_: int, row: int) -> bool:
        """Move fingerprints on to their other rows until one finds a free cell."""
        table = self.table
        for kick in range(MAX_KICKS):
            free = np.flatnonzero(table[row] == 0)
            if len(free):
                table[row, free[0]] = print_
                return True
            way = (print_ + kick) % WAYS
            print_, table[row, way] = int(table[row, way]), print_
            row ^= int(self._step(print_))
        return False

    def delete(self, keys: np.ndarray) -> None:
        for print_, *rows in zip(*(x.tolist() for x in self._places(keys))):
            for row in rows:
                at = np.flatnonzero(self.table[row] == print_)
                if len(at):
                    self.table[row, at[0]] = 0
                    break


def _keys(digests) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(d[:8]) for d in digests), "<u8").astype(np.uint64)


def _filter_row(bucket: int, f: CuckooFilter | None, overflow: bool) -> pd.DataFrame:
    return pd.DataFrame({"bucket": [bucket], "overflow": [overflow],
                         "cells": [f.table.tobytes() if f is not None else b""]})


def _load(filters: pd.DataFrame) -> CuckooFilter:
    if not len(filters):
        return CuckooFilter()
    return CuckooFilter(table=np.frombuffer(filters["cells"].iloc[0], np.uint16).reshape(-1, WAYS).copy())


FILTER = "bucket int, overflow boolean, cells binary"


class CuckooIndex:
    """Live digests (column ``digest``, binary); filters and keys are written tables.

    ``expected`` keys choose the first number of buckets; it grows with what is inserted."""

    def __init__(self, spark: SparkSession, expected: int = 0, bucket_keys: int = BUCKET_KEYS):
        self.spark, self.bucket_keys = spark, bucket_keys
        self.buckets, self.size = max(1, -(-expected // bucket_keys)), 0
        empty = spark.createDataFrame([], "digest binary, stamp int")
        self.keys, self.gone, self.stamp = empty, empty, 0
        self.filters = spark.createDataFrame([], FILTER)

    def _bucketed(self, digests: DataFrame) -> DataFrame:
        return digests.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(self.buckets)).cast("int"))

    def live(self) -> DataFrame:
        """Stored keys without those deleted after they were stored."""
        last = self.gone.groupBy("digest").agg(F.max("stamp").alias("deleted"))
        return (self.keys.join(last, "digest", "left")
                .where(F.col("deleted").isNull() | (F.col("stamp") > F.col("deleted"))).select("digest"))

    def lookup(self, digests: DataFrame) -> DataFrame:
        """Distinct ``digest`` rows with ``hit`` and ``held``: filter misses are new, hits are verified."""
        def probe(batch: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            f = _load(filters)
            return batch.assign(hit=f.contains(_keys(batch["digest"])) if len(batch) else False)

        batch = self._bucketed(digests.select("digest"))
        probed = stage(batch.groupBy("bucket").cogroup(self.filters.groupBy("bucket")).applyInPandas(
            probe, "digest binary, bucket int, hit boolean"), "cuckoo-probe")
        verified = probed.where("hit").select("digest").join(self.live(), "digest", "left_semi").withColumn(
            "held", F.lit(True))
        return probed.join(verified, "digest", "left").select(
            "digest", "hit", F.coalesce("held", F.lit(False)).alias("held"))

    def insert(self, digests: DataFrame) -> DataFrame:
        """Add distinct digests; returns them with ``held`` (true: was live before)."""
        found = stage(self.lookup(digests), "cuckoo-found")
        new = found.where(~F.col("held")).select("digest")
        self.size += new.count()
        if self.size > self.buckets * self.bucket_keys:
            self._spread(max(2 * self.buckets, -(-self.size // self.bucket_keys)))

        def put(batch: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            bucket = int((batch if len(batch) else filters)["bucket"].iloc[0])
            f = _load(filters)
            ok = f.insert(_keys(batch["digest"])) if len(batch) else True
            return _filter_row(bucket, f, not ok)

        filters = stage(self._bucketed(new).groupBy("bucket").cogroup(self.filters.groupBy("bucket")).applyInPandas(
            put, FILTER), "cuckoo-filters")
        self.stamp += 1
        self.keys = self.keys.unionByName(stage(new.withColumn("stamp", F.lit(self.stamp)), "cuckoo-keys"))
        self.filters = self._resized(filters)
        return found.select("digest", "held")

    def _rebuilt(self, keys: DataFrame, slots: int) -> DataFrame:
        """Filters of at least ``slots`` from the stored keys (digest, bucket)."""
        def build(part: pd.DataFrame) -> pd.DataFrame:
            values, wanted = _keys(part["digest"]), slots
            while True:
                f = CuckooFilter(max(wanted, int(len(values) / 0.9)))
                if f.insert(values):
                    return _filter_row(int(part["bucket"].iloc[0]), f, False)
                wanted = 2 * f.table.size

        return keys.groupBy("bucket").applyInPandas(build, FILTER)

    def _spread(self, buckets: int) -> None:
        """Split the index into more buckets; every filter is built anew from the stored keys."""
        self.buckets = buckets
        self.filters = stage(self._rebuilt(self._bucketed(self.live()), SLOTS), "cuckoo-filters")

    def _resized(self, filters: DataFrame) -> DataFrame:
        """Rebuild overflown filters from their buckets' stored keys, large enough for them."""
        full = filters.where("overflow").select("bucket")
        keys = self._bucketed(self.live()).join(full, "bucket", "left_semi")
        return stage(filters.where(~F.col("overflow")).unionByName(self._rebuilt(keys, 2 * SLOTS)), "cuckoo-filters")

    def delete(self, digests: DataFrame) -> None:
        """Take live digests out of the filters and the key set; others are ignored."""
        out = stage(self._bucketed(self.lookup(digests).where("held").select("digest")), "cuckoo-deleted")

        def take(batch: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            f = _load(filters)
            f.delete(_keys(batch["digest"]))
            bucket = int((batch if len(batch) else filters)["bucket"].iloc[0])
            return _filter_row(bucket, f, False)

        self.filters = stage(out.groupBy("bucket").cogroup(self.filters.groupBy("bucket")).applyInPandas(
            take, FILTER), "cuckoo-filters")
        self.size -= out.count()
        self.gone = self.gone.unionByName(out.select("digest", F.lit(self.stamp).alias("stamp")))


def document_digests(docs: DataFrame, row: str | None = None) -> DataFrame:
    """(row, doc_id, points, digest) of every row; texts are read once."""
    text = F.coalesce("text", F.lit(""))
    return docs.select((F.col(row) if row else F.monotonically_increasing_id()).alias("row"), "doc_id", F.char_length(text).alias("points"),
                       F.unhex(F.sha2(F.translate(text, BLANKS, ""), 256)).alias("digest"))


def _merged(groups: DataFrame) -> DataFrame:
    return groups.groupBy("digest").agg(F.min("best").alias("best"), F.sum("n").alias("n"))


def exact_groups(docs: DataFrame, row: str | None = None, batches: int = BATCHES,
                 bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """One row per document: ``row`` (from the column ``row`` names, or numbered here), ``doc_id``,
    ``keep_row``, ``keep_id``, ``group_size``, ``kept`` and the ``digest``, from batches inserted
    one after the other into the index."""
    rows = stage(document_digests(docs, row).withColumn("batch", F.pmod(F.xxhash64("row"), F.lit(batches))), "digests")
    best = F.struct((-F.col("points")).alias("p"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    distinct = rows.agg(F.approx_count_distinct("digest")).first()[0]
    # the estimate is within some 5 %; the index grows by itself beyond it
    index = CuckooIndex(docs.sparkSession, distinct * 11 // 10, bucket_keys)
    entries, updates = None, None
    for k in range(batches):
        groups = stage(rows.where(F.col("batch") == k).groupBy("digest").agg(
            F.min(best).alias("best"), F.count(F.lit(1)).alias("n")), "digest-groups")
        marked = stage(groups.join(index.insert(groups), "digest"), "digest-marked")
        first, again = (marked.where(c).select("digest", "best", "n") for c in (~F.col("held"), F.col("held")))
        entries = first if entries is None else entries.unionByName(first)
        updates = again if updates is None else updates.unionByName(again)
    later = _merged(updates).select("digest", F.col("best").alias("best2"), F.col("n").alias("n2"))
    live = entries.join(later, "digest", "left").select(
        "digest", F.least("best", F.coalesce("best2", "best")).alias("best"),
        (F.col("n") + F.coalesce("n2", F.lit(0))).alias("group_size"))
    return rows.join(live, "digest").select(
        "row", "doc_id", F.col("best.row").alias("keep_row"), F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), "digest")
