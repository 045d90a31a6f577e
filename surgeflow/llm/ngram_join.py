"""N-gram Jaccard join: MinHash banding finds candidates, full n-gram sets verify them.

1. One pass computes each document's set of 5-word shingles (64-bit hashes), a 128-bit hash of
   the whole set and the band hashes of its MinHash signature.  Documents with equal sets are
   one class of copies; only its representative goes on.
2. Representatives are shuffled on band hashes.  Buckets become stars around their smallest
   member, and the stars connect into components.
3. Pairs are verified in units.  A component is one unit where that costs less than its
   buckets (a group of near copies, whose pairs meet in many bands), otherwise each of its
   distinct buckets is one (a chain of texts, whose ends meet in none), and a pair counts in
   the bucket of the first band in which it meets.  So every pair that meets is verified and
   counted once, and the work of a component never exceeds that of its buckets.
4. The shingle sets of candidates are gathered per unit.  A unit larger than ``BLOCK``
   members or ``BLOCK_GRAMS`` shingles is cut into blocks by hash and every pair of blocks is
   one task, so no group is ever in one task whole.  Inside a task all set intersections are
   one matrix product.  A task returns counts of links and a spanning forest, never the pairs.
5. Components of the spanning edges are the near-duplicate classes.

Band and row counts come from ``target_recall`` at the threshold (``bands_for``).

Edge cases: a text of one to four words is one shingle; texts without words are equal to
each other and to nothing else; repeated rows are copies; an id may be null; an empty table
gives an empty result; only ``doc_id`` and ``text`` are read.
"""
from __future__ import annotations

import math
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, gram_hashes, map_batches, mix, stage, with_rows, word_hashes

WORDS, THRESHOLD, TARGET_RECALL = 5, 0.8, 0.9999
#: Representatives and shingles per block of a large component.
BLOCK, BLOCK_GRAMS = 1024, 1 << 21
#: Cost of gathering a member's shingles in a unit, in comparisons of one pair.
ROW_COST = 64


def bands_for(threshold: float, target_recall: float, rows: int = 4) -> tuple[int, int]:
    """(bands, rows): least bands for which a pair at the threshold is found with the recall."""
    return math.ceil(math.log(1 - target_recall) / math.log(1 - threshold ** rows)), rows


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    h = word_hashes(text)
    if 0 < len(h) < words:
        return gram_hashes(h, tuple(range(len(h))))
    return np.unique(gram_hashes(h, tuple(range(words))))


def band_hashes(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """MinHash signature by ``bands * rows`` odd multipliers, hashed per band."""
    numbers = np.arange(1, bands * rows + 1, dtype=np.uint64)
    factors, shifts = mix(numbers) | np.uint64(1), mix(numbers + np.uint64(1 << 40))
    least = np.full(len(numbers), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), 256):
        part = grams[at:at + 256, None] * factors + shifts
        np.minimum(least, part.min(axis=0), out=least)
    out = np.arange(bands, dtype=np.uint64)
    for column in least.reshape(bands, rows).T:
        out = mix(out * np.uint64(0x9FB21C651E98DF25) + column)
    return out


def signatures(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """(row, doc_id, set_a, set_b, n_grams, band_hashes) for documents with a ``row`` number."""
    schema = T.StructType([T.StructField("row", T.LongType()), docs.schema["doc_id"],
                           T.StructField("set_a", T.LongType()), T.StructField("set_b", T.LongType()),
                           T.StructField("n_grams", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))])

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets, counts, hashes, ends = [], [], [], [0]
        for text in as_bytes(batch.column(2)):
            grams = shingles(text, words)
            sets.append(xxhash.xxh3_128_digest(grams.tobytes()))
            counts.append(len(grams))
            if len(grams):
                hashes.append(band_hashes(grams, bands, rows))
            ends.append(len(hashes) * bands)
        both = np.frombuffer(b"".join(sets), "<i8").reshape(-1, 2)
        flat = np.concatenate(hashes).view(np.int64) if hashes else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()),
             pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
            [f.name for f in schema])

    return map_batches(docs.select("row", "doc_id", "text"), sign, schema)


def components(edges: DataFrame) -> DataFrame:
    """(node, label): smallest node of each connected component of edges (a, b).

    Every round a node takes the least label among its neighbours and its label's label;
    rounds end when nothing changes.  Each round is a written table.
    """
    both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                 .where("a <> b").distinct(), "cc-edges")
    labels = stage(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("label"), F.lit(True).alias("moved")), "cc-labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy("a").agg(F.min("label").alias("m")))
        up = labels.select(F.col("node").alias("p"), F.col("label").alias("pl"))
        new = (labels.join(near, F.col("node") == F.col("a")).join(up, F.col("label") == F.col("p"))
               .select("node", F.least("m", "pl", "label").alias("new"), "label"))
        labels = stage(new.select("node", F.col("new").alias("label"), (F.col("new") < F.col("label")).alias("moved")),
                       "cc-labels")
        if labels.where("moved").isEmpty():
            return labels.select("node", "label")


def _forest(near: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what the boolean matrix (left x right) connects."""
    edges, n = [], len(left)
    open_left, open_right = np.ones(n, bool), np.ones(len(right), bool)
    for seed in range(n):
        if not open_left[seed]:
            continue
        open_left[seed], todo = False, [seed]
        while todo:
            i = todo.pop()
            for j in np.flatnonzero(near[i] & open_right):
                edges.append((left[i], right[j]))
                open_right[j] = False
                for k in np.flatnonzero(near[:, j] & open_left):
                    edges.append((left[k], right[j]))
                    open_left[k] = False
                    todo.append(k)
    return edges


def _compare(a: pd.DataFrame, b: pd.DataFrame, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(near, left ids, right ids) by one product over the shingles that two members share."""
    def flat(part: pd.DataFrame):
        sets = [np.frombuffer(g, "<u8") for g in part["grams"]]
        return np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets]), \
            np.array([len(s) for s in sets], np.float32)

    (ga, ia, na), (gb, ib, nb) = flat(a), flat(b)
    shared = np.intersect1d(ga, gb) if a is not b else np.unique(ga)
    common = np.zeros((len(na), len(nb)), np.float32)
    for at in range(0, len(shared), 2048):
        part = shared[at:at + 2048]
        left, right = (np.zeros((n, len(part)), np.float32) for n in (len(na), len(nb)))
        for g, i, m in ((ga, ia, left), (gb, ib, right)):
            column = np.minimum(np.searchsorted(part, g), len(part) - 1)
            ok = part[column] == g
            m[i[ok], column[ok]] = 1
        common += left @ right.T
    union = na[:, None] + nb[None, :] - common
    return common >= np.float32(threshold) * union - 1e-4, a["row"].to_numpy(), b["row"].to_numpy()


LINKS = "a long, b long, links long"
UNITS = "array<struct<component: long, band: int, hash: long, members: long, total: long>>"


def units_of(reps: DataFrame, stars: DataFrame, row_cost: int = ROW_COST) -> DataFrame:
    """(row, units): the units of verification that hold each candidate.

    ``reps``: (row, n_grams, bands); ``stars``: the ``band_stars`` of their buckets.  A unit is
    (component, band, hash, members, total shingles); band -1 is a whole component."""
    members = components(edges_of(reps, stars))
    per_row = members.join(reps.select(F.col("row").alias("node"), "n_grams"), "node")
    sizes = per_row.groupBy("label").agg(F.count(F.lit(1)).alias("members"), F.sum("n_grams").alias("total"))
    # equal buckets of several bands are one unit, that of the first band
    sets = stars.groupBy("centre", "n", "total", "same", "same2").agg(F.min(F.struct("band", "hash")).alias("first"))
    sets = sets.join(members.select(F.col("node").alias("centre"), "label"), "centre")
    costs = sets.groupBy("label").agg(F.sum(F.col("n") * (F.col("n") + row_cost)).alias("cost"))
    whole = stage(sizes.join(costs, "label").withColumn(
        "whole", F.col("members") * (F.col("members") + row_cost) <= F.col("cost")), "components")
    at_once = members.join(whole.where("whole"), "label").select(
        F.col("node").alias("row"), F.col("label").alias("component"), F.lit(-1).alias("band"),
        F.lit(0).cast("long").alias("hash"), "members", "total")
    cut = whole.where("not whole").select("label")
    inside = reps.join(members.join(cut, "label", "left_semi").select(F.col("node").alias("row")), "row", "left_semi")
    by_bucket = inside.select("row", F.posexplode("bands").alias("band", "hash")).join(
        sets.join(cut, "label", "left_semi").select(
            F.col("label").alias("component"), "first.band", "first.hash", F.col("n").alias("members"), "total"),
        ["band", "hash"]).select("row", "component", "band", "hash", "members", "total")
    unit = F.struct("component", "band", "hash", "members", "total")
    return at_once.unionByName(by_bucket).groupBy("row").agg(F.collect_list(unit).alias("units"))


def band_stars(reps: DataFrame) -> DataFrame:
    """Buckets of two members or more: (band, hash), the least row, members, shingles and a hash of the members."""
    return (reps.select("row", "n_grams", F.posexplode("bands").alias("band", "hash")).groupBy("band", "hash")
            .agg(F.min("row").alias("centre"), F.count(F.lit(1)).alias("n"), F.sum("n_grams").alias("total"),
                 F.bit_xor(F.xxhash64("row")).alias("same"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("same2"))
            .where("n > 1"))


def edges_of(reps: DataFrame, stars: DataFrame) -> DataFrame:
    """Edges (a, b) that connect the members of each bucket with its least one.

    A row has one edge, to the least of its centres (at most one a band); its other centres
    have edges to that one.  So members that share their centres add one edge each."""
    buckets = reps.select("row", F.posexplode("bands").alias("band", "hash"))
    centres = buckets.join(stars.select("band", "hash", "centre"), ["band", "hash"]).where("row <> centre").groupBy(
        "row").agg(F.collect_set("centre").alias("centres"))
    ends = centres.select(F.explode(F.array_append("centres", F.col("row"))).alias("a"), F.array_min("centres").alias("b"))
    return ends.where("a <> b").distinct()


def verified_links(sets: DataFrame, threshold: float, block: int) -> DataFrame:
    """Spanning edges (a, b) and, with b null, counts of links of a node.

    ``sets``: (component, band, hash, members, total, row, bands, grams) of candidates; ``bands``
    is needed only where the unit is a bucket."""
    blocks = F.ceil(F.greatest(F.col("members") / block, F.col("total") / BLOCK_GRAMS)).cast("int")
    mine = F.pmod(F.xxhash64("row"), blocks).cast("int")
    unit = ("component", "band", "hash")
    placed = sets.select(*unit, "row", "bands", "grams", blocks.alias("blocks"), mine.alias("mine"))
    pair = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tasks = placed.withColumn("other", pair).select(
        *unit, F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "mine", "row", "bands",
        "grams")

    def verify(key: tuple[Any, ...], part: pd.DataFrame) -> pd.DataFrame:
        _, band, _, x, y = key
        a = part[part["mine"] == x]
        b = a if x == y else part[part["mine"] == y]
        if not len(a) or not len(b) or (x == y and len(a) < 2):
            return pd.DataFrame({"a": [], "b": [], "links": []})
        near, left, right = _compare(a, b, threshold)
        if x == y:
            np.fill_diagonal(near, False)
        if band > 0:  # pairs that meet in an earlier band count there
            first, second = np.stack(a["bands"].to_numpy()), np.stack(b["bands"].to_numpy())
            for k in range(band):
                near &= first[:, k, None] != second[None, :, k]
        edges = _forest(near, left, right)
        counts = [(r, None, int(n)) for r, n in zip(left, near.sum(axis=1)) if n]
        if x != y:
            counts += [(r, None, int(n)) for r, n in zip(right, near.sum(axis=0)) if n]
        rows = [(i, j, 0) for i, j in edges] + counts
        return pd.DataFrame(rows, columns=["a", "b", "links"]).astype({"a": "Int64", "b": "Int64", "links": "int64"})

    return tasks.groupBy(*unit, "x", "y").applyInPandas(verify, LINKS)


def near_classes(docs: DataFrame, row: str | None = None, words: int = WORDS, threshold: float = THRESHOLD,
                 target_recall: float = TARGET_RECALL, block: int = BLOCK, row_cost: int = ROW_COST) -> DataFrame:
    """One row per document: ``row`` (from the unique column ``row`` names, or numbered here),
    ``doc_id``, ``class_row`` and ``class_id`` (row and id of
    the class's first document), ``class_size``, ``copies`` (documents with the same shingles,
    itself included), ``n_links`` (other texts at the threshold or above) and ``n_grams``."""
    bands, rows = bands_for(threshold, target_recall)
    docs = docs.select(F.col(row).alias("row"), "doc_id", "text") if row else with_rows(docs, "near-docs")
    signed = stage(signatures(docs, words, bands, rows), "signatures")
    copies = signed.groupBy("set_a", "set_b").agg(F.min("row").alias("rep"), F.count(F.lit(1)).alias("copies"))
    copies = stage(copies, "copies")
    reps = signed.join(copies.select(F.col("rep").alias("row")), "row", "left_semi")
    stars = stage(band_stars(reps), "band-stars")
    bands_of = F.when(F.exists("units", lambda u: u["band"] >= 0), F.col("bands")).alias("bands")
    wanted = stage(units_of(reps, stars, row_cost).join(reps.select("row", "bands"), "row")
                   .select("row", "units", bands_of), "candidates")
    texts = docs.select("row", "text").join(wanted.hint("shuffle_hash"), "row")

    def grams(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingles(t, words).tobytes() for t in as_bytes(batch.column(3))]
        return pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.binary())],
                                          ["row", "units", "bands", "grams"])

    sets = map_batches(texts.select("row", "units", "bands", "text"), grams,
                       f"row long, units {UNITS}, bands array<long>, grams binary")
    sets = sets.select("row", "bands", "grams", F.explode("units").alias("unit")).select("unit.*", "row", "bands", "grams")
    links = stage(verified_links(sets, threshold, block), "links")
    counts = links.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("n_links"))
    classes = components(links.where("b is not null")).select(F.col("node").alias("rep"), F.col("label").alias("class_row"))
    per_copy = copies.join(classes, "rep", "left").join(counts, "rep", "left").select(
        "set_a", "set_b", F.coalesce("class_row", "rep").alias("class_row"), "copies",
        F.coalesce("n_links", F.lit(0)).alias("n_links"))
    per_copy = stage(per_copy, "copy-classes")
    heads = (per_copy.groupBy("class_row").agg(F.sum("copies").alias("class_size"))
             .join(signed.select(F.col("row").alias("class_row"), F.col("doc_id").alias("class_id")), "class_row"))
    # a class is no larger than its texts, so the heads join the classes of copies, not the documents
    known = per_copy.join(heads, "class_row")
    return signed.select("row", "doc_id", "set_a", "set_b", "n_grams").join(known, ["set_a", "set_b"]).select(
        "row", "doc_id", "class_row", "class_id", "class_size", "copies", "n_links", "n_grams")
