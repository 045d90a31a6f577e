"""Toxicity scores: FTRL-proximal logistic regression over hashed n-grams and skip-grams.

Features of a text are the distinct hashed words, word pairs and pairs that skip one word.
Words and pairs have hash ranges of their own, so the many pairs of a long text cannot
collide with single words.  FTRL-proximal keeps per-coordinate rates and L1 sparsity.  Training
runs on ``shards`` tasks in parallel, each over the rows of one hash of the id; after each
epoch the states of all coordinates they touched are averaged per coordinate, and only then
are those dropped that L1 keeps at zero.  The sample is bounded by ``max_rows`` labelled rows
(drawn by hash, so alike for every table size) and the model by the hash ranges, so it may be
broadcast.

Edge cases: null and empty texts have no features and get the score of the bias; labels that
are null or without document are left out; a table without labels (or with one class) gives
the prior as every score; repeated rows are scored alike and learned from once; if the drawn
ids have more different texts than ``max_rows`` allows, those are drawn by hash too; ids may
be null.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, forget_words, gram_hashes, stage, word_hashes

#: Coordinates of one packed row.
RANGE = 1 << 16


@dataclass(frozen=True)
class Settings:
    word_bits: int = 20
    pair_bits: int = 22
    pair_value: float = 0.2
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 1.5
    l2: float = 0.0
    epochs: int = 4
    shards: int = 4
    max_rows: int = 20_000

    @property
    def size(self) -> int:
        """Coordinates: words, pairs, and the bias as the last one."""
        return (1 << self.word_bits) + (1 << self.pair_bits) + 1


def feature_indices(text: bytes, s: Settings) -> np.ndarray:
    """Coordinates of a text's words, pairs and skip pairs (with repeats)."""
    h = word_hashes(text)
    pairs = np.concatenate((gram_hashes(h, (0, 1)), gram_hashes(h, (0, 2)) ^ np.uint64(0x5851F42D4C957F2D)))
    return np.concatenate((h >> np.uint64(64 - s.word_bits),
                           (pairs >> np.uint64(64 - s.pair_bits)) + np.uint64(1 << s.word_bits))).astype(np.int64)


def pack_features(at: np.ndarray) -> bytes:
    """Gaps of sorted coordinates, byte plane by byte plane (the high planes compress away)."""
    return np.diff(at, prepend=0).astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack_features(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<i4").ravel(), dtype=np.int64)


def values_of(at: np.ndarray, s: Settings) -> np.ndarray:
    """Feature values: 1 for words and the bias, ``pair_value`` for pairs."""
    return np.where((at < 1 << s.word_bits) | (at == s.size - 1), 1.0, s.pair_value)


def weights_of(z: np.ndarray, n: np.ndarray, s: Settings) -> np.ndarray:
    """FTRL-proximal closed form; the last coordinate (bias) has no L1."""
    l1 = np.full(len(z), s.l1)
    shrunk = np.sign(z) * np.maximum(0.0, np.abs(z) - l1)
    return -shrunk / ((s.beta + np.sqrt(n)) / s.alpha + s.l2)


def ftrl_pass(examples: list[tuple[np.ndarray, float]], z: np.ndarray, n: np.ndarray, s: Settings) -> None:
    """One pass over (distinct coordinates, label), updating z and n in place."""
    bias = s.size - 1
    for index, label in examples:
        at = np.append(index, bias)
        zs, ns, x = z[at], n[at], values_of(at, s)
        w = weights_of(zs, ns, s)
        w[-1] = -zs[-1] / ((s.beta + np.sqrt(ns[-1])) / s.alpha + s.l2)
        g = (1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
        rate = (np.sqrt(ns + g * g) - np.sqrt(ns)) / s.alpha
        z[at] += g - rate * w
        n[at] += g * g


def training_sample(docs: DataFrame, labels: DataFrame, s: Settings) -> DataFrame:
    """(label, features, shard, drawn) of at most about ``max_rows`` ids, by hash of the id; one row
    per id and text, with a number in [0, 1) by hash of both."""
    labels = labels.select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("double").alias("label")).where(
        "label is not null and label_id is not null")
    drawn = F.pmod(F.xxhash64("label_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # one row per labelled id, whatever the label table repeats
    labels = labels.groupBy("label_id").agg(F.max("label").alias("label"))
    count = labels.count()
    labels = labels.where(drawn < min(1.0, s.max_rows / max(1, count)))
    # the drawn labels are bounded by max_rows, so no text is shuffled for the join
    rows = docs.select("doc_id", "text").join(F.broadcast(labels), F.col("doc_id") == F.col("label_id"))
    # copies collapse map-side, so a repeated row weighs once and no task holds its copies
    rows = rows.select("doc_id", "text", "label").distinct()

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [pack_features(np.unique(feature_indices(t, s))) for t in as_bytes(batch.column(0))]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.binary()), *batch.columns[2:]],
                                             ["label", "features", "shard", "drawn"])
        forget_words()

    shard = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(s.shards))
    drawn = F.pmod(F.xxhash64("text", "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return stage(rows.select("text", "label", shard.alias("shard"), drawn.alias("drawn")).mapInArrow(
        features, "label double, features binary, shard long, drawn double"), "toxicity-sample")


def bounded(sample: DataFrame, s: Settings) -> DataFrame:
    """At most about ``max_rows`` rows, also where ids have many different texts."""
    rows = sample.count()
    # the draw of ids is only near max_rows; that much more is left alone
    return sample.where(F.col("drawn") < s.max_rows / rows) if rows > 1.1 * s.max_rows else sample


def pack_state(index: np.ndarray, z: np.ndarray, n: np.ndarray) -> Iterator[dict]:
    """One row per range of ``RANGE`` coordinates: a bit for each that was touched, and the float32
    pairs (z, n) of those, which repeat where coordinates share their examples."""
    cuts = np.searchsorted(index, np.arange(0, index[-1] + RANGE + 1, RANGE))
    for k, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
        if hi > lo:
            touched = np.zeros(RANGE, bool)
            touched[index[lo:hi] - k * RANGE] = True
            pairs = np.column_stack((z[lo:hi], n[lo:hi])).astype("<f4").tobytes()
            yield {"range": k, "touched": np.packbits(touched).tobytes(),
                   "pairs": pa.compress(pairs, codec="zstd", asbytes=True)}


def merge_states(part: pd.DataFrame, s: Settings) -> pd.DataFrame:
    """The mean of a range over the shards that touched each coordinate; then the bias, and
    coordinates that L1 may let off zero (the others matter only while an epoch goes on)."""
    first = int(part["range"].iloc[0]) * RANGE
    shards, total = np.zeros(RANGE), np.zeros((RANGE, 2))
    part = part.sort_values(["touched", "pairs"])  # sums in the same order in every run
    for touched, pairs in zip(part["touched"], part["pairs"]):
        at = np.flatnonzero(np.unpackbits(np.frombuffer(touched, np.uint8)))
        shards[at] += 1
        raw = pa.decompress(pairs, decompressed_size=8 * len(at), codec="zstd", asbytes=True)
        total[at] += np.frombuffer(raw, "<f4").reshape(-1, 2)
    z, n = total.T / np.maximum(1, shards)
    at = np.flatnonzero((shards > 0) & ((np.abs(z) > s.l1 / 4) | (first + np.arange(RANGE) == s.size - 1)))
    return pd.DataFrame({"at": first + at, "z": z[at], "n": n[at]})


def train(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> tuple[np.ndarray, np.ndarray, float]:
    """(coordinates, weights times feature values, bias) of the non-zero weights."""
    sample = bounded(training_sample(docs, labels, s), s)
    rows, positives = sample.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not rows or not positives or positives == rows:
        prior = ((positives or 0.0) + 0.5) / (rows + 1.0)
        return np.zeros(0, np.int64), np.zeros(0), float(np.log(prior / (1 - prior)))
    z, n = np.zeros(s.size), np.zeros(s.size)
    for epoch in range(s.epochs):
        at = np.flatnonzero(n)
        state = sample.sparkSession.sparkContext.broadcast((at, z[at], n[at]))

        def learn(part: pa.Table) -> pa.Table:
            index, z0, n0 = state.value
            z, n = np.zeros(s.size), np.zeros(s.size)
            z[index], n[index] = z0, n0
            # in an order of their own, whatever files and tasks they came from
            examples = sorted(zip(part["features"].to_pylist(), part["label"].to_pylist()))
            order = np.random.default_rng(epoch).permutation(len(examples))
            ftrl_pass([(unpack_features(examples[k][0]), examples[k][1]) for k in order], z, n, s)
            index = np.flatnonzero(n)
            return pa.Table.from_pylist(list(pack_state(index, z[index], n[index])), schema=pa.schema([
                ("range", pa.int32()), ("touched", pa.binary()), ("pairs", pa.binary())]))

        # one group per shard, then one row per range and shard
        merged = (sample.groupBy("shard").applyInArrow(learn, "range int, touched binary, pairs binary")
                  .groupBy("range").applyInPandas(lambda part: merge_states(part, s), "at long, z double, n double")
                  .toPandas())
        state.destroy()
        z, n = np.zeros(s.size), np.zeros(s.size)
        z[merged["at"]], n[merged["at"]] = merged["z"], merged["n"]
    w = weights_of(z, n, s)
    bias = -z[-1] / ((s.beta + np.sqrt(n[-1])) / s.alpha + s.l2)
    at = np.flatnonzero(w[:-1])
    return at, (w[at] * values_of(at, s)), float(bias)


def score_column(model: tuple[np.ndarray, np.ndarray, float], text: Column, spark,
                 s: Settings = Settings()) -> Column:
    """Score of every whole text; the model is at most one weight per coordinate."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index, w, bias = shared.value
        dense = np.zeros(s.size, np.float32)
        dense[index] = w

        def one(value: str | None) -> float:
            at = feature_indices((value or "").encode("utf-8", "surrogatepass"), s)
            at = np.unique(at[dense[at] != 0])
            return 1.0 / (1.0 + np.exp(-np.clip(dense[at].sum(dtype=np.float64) + bias, -35, 35)))

        for batch in batches:
            yield pd.Series([one(t) for t in batch], dtype="float64")
        forget_words()

    return score(text)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def toxicity_scores(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``docs`` (``doc_id``, ``text``) with ``held_out``, ``score`` and ``predicted``."""
    model = train(docs, labels.where(~held_out(F.col("doc_id"))), s)
    score = score_column(model, F.col("text"), docs.sparkSession, s)
    return docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"), score.alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
