"""Benchmark decontamination over a distributed positional inverted index.

The index is a table of segments: about ``SEGMENT_WORDS`` words of whole documents, as a term
list, a count per term and the delta-coded positions of every term.  A search reads the
segments where they lie (nothing of the documents is shuffled).  For each test phrase it
starts from the posting list of the globally rarest term, shifted by the term's place in
the phrase, and intersects it with the shifted lists of the other terms, rarest first.  All
phrases of a block of test items go through each step together.

The test set is read in blocks of about ``BLOCK_CHARS`` characters, so what a task holds of
it is bounded whatever its size.

Edge cases: null and empty texts have no words, no hits and are not contaminated; items
without words have no windows; repeated documents each get their row; items that share an
id count once; a null item id is reported as ``null``; a document of any length lies in one
segment; an empty table on either side gives zero counts.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, stage, words_of

SEGMENT_WORDS = 1 << 20
BLOCK_CHARS = 4 << 20
#: Fixed values of the contract: words of a window; share of hit words is at least 1 / 20.
WINDOW, SHARE = 13, 20


# ------------------------------------------------------------------------------ index

def build_index(docs: DataFrame) -> DataFrame:
    """Write the segments of ``docs`` (``doc_id``, ``text``) and return their table."""
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_ids", T.ArrayType(id_type)), T.StructField("starts", T.BinaryType()),
                           T.StructField("terms", T.BinaryType()), T.StructField("counts", T.BinaryType()),
                           T.StructField("deltas", T.BinaryType())])

    def segment(ids: pa.Array, words: list[bytes], starts: list[int]) -> pa.RecordBatch:
        terms = list(dict.fromkeys(words))
        place = {t: i for i, t in enumerate(terms)}
        codes = np.fromiter(map(place.__getitem__, words), np.int32, len(words))
        postings = np.argsort(codes, kind="stable").astype("<i4")
        blobs = (np.asarray(starts, "<i4"), b"\n".join(terms), np.bincount(codes, minlength=len(terms)).astype("<i4"),
                 np.diff(postings, prepend=np.int32(0)).astype("<i4"))
        columns = [pa.array([b if isinstance(b, bytes) else b.tobytes()], pa.binary()) for b in blobs]
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), *columns], [f.name for f in schema])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, first, words, starts = batch.column(0), 0, [], [0]
            for at, text in enumerate(as_bytes(batch.column(1))):
                words += words_of(text)
                starts.append(len(words))
                if len(words) >= SEGMENT_WORDS or at == batch.num_rows - 1:
                    yield segment(ids.slice(first, at + 1 - first), words, starts)
                    first, words, starts = at + 1, [], [0]

    made = docs.select("doc_id", "text").mapInArrow(build, schema)
    return stage(made.withColumn("segment", F.monotonically_increasing_id()), "positional-index")


class Segment:
    """One segment's postings as sorted (term, position) keys."""

    def __init__(self, terms: bytes, counts: bytes, deltas: bytes, starts: bytes):
        self.place = {t: i for i, t in enumerate(terms.split(b"\n"))} if counts else {}
        counts = np.frombuffer(counts, "<i4")
        self.starts = np.frombuffer(starts, "<i4")
        self.size = max(1, int(self.starts[-1]))
        postings = np.cumsum(np.frombuffer(deltas, "<i4"), dtype=np.int64)
        self.keys = np.repeat(np.arange(len(counts), dtype=np.int64) * self.size, counts) + postings
        self.first = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))

    def codes(self, terms: list[bytes]) -> np.ndarray:
        return np.fromiter((self.place.get(t, -1) for t in terms), np.int64, len(terms))

    def postings(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``codes``, position) of every posting of every code."""
        n = self.first[codes + 1] - self.first[codes]
        owner = np.repeat(np.arange(len(codes)), n)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[codes], n)
        return owner, self.keys[at] - np.repeat(codes, n) * self.size

    def next_posting(self, codes: np.ndarray, positions: np.ndarray) -> np.ndarray:
        """The first posting of each code at or after a position (a huge number if none)."""
        wanted = codes * self.size + positions
        at = np.searchsorted(self.keys, wanted)
        found = self.keys[np.minimum(at, len(self.keys) - 1)]
        return np.where((at < len(self.keys)) & (found < (codes + 1) * self.size), found - codes * self.size, 1 << 60)

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, side="right") - 1


# --------------------------------------------------------------------------- phrases

@dataclass
class Phrases:
    """The distinct windows of a block of items, by window length."""
    terms: list[bytes]
    items: list[str]
    windows: dict[int, np.ndarray]  # length -> (n, length) term numbers
    owners: dict[int, list[list[int]]]  # length -> item numbers of each window


def phrases_of(rows: list[tuple], window: int = WINDOW) -> Phrases:
    """``rows``: (item_id, text). Items shorter than a window are one window."""
    terms: dict[bytes, int] = {}
    items: dict[str, int] = {}
    found: dict[int, dict[tuple, list[int]]] = {}
    for item, text in rows:
        number = items.setdefault("null" if item is None else str(item), len(items))
        codes = [terms.setdefault(w, len(terms)) for w in words_of((text or "").encode())]
        size = min(window, len(codes))
        for at in range(len(codes) - size + 1 if size else 0):
            owners = found.setdefault(size, {}).setdefault(tuple(codes[at:at + size]), [])
            if number not in owners:
                owners.append(number)
    return Phrases(list(terms), list(items), {k: np.array(list(v), np.int64) for k, v in found.items()},
                   {k: list(v.values()) for k, v in found.items()})


def item_blocks(items: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple]]:
    """The distinct items in blocks of about ``block_chars`` characters (an id counts once anyway)."""
    items = items.select("item_id", "text").distinct()
    total = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    n = 1 + total // block_chars
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else items
        yield [tuple(r) for r in part.collect()]


def term_frequencies(index: DataFrame, phrases: Phrases) -> np.ndarray:
    """Occurrences of the block's terms in the whole index (bounded by the block)."""
    shared = index.sparkSession.sparkContext.broadcast(phrases.terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for terms, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if counts:
                    place = {t: i for i, t in enumerate(terms.split(b"\n"))}
                    codes = np.fromiter((place.get(t, -1) for t in shared.value), np.int64, len(shared.value))
                    total += np.where(codes >= 0, np.frombuffer(counts, "<i4")[codes], 0)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(at), "n": pa.array(total[at])})

    got = index.select("terms", "counts").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n"))
    freq = np.zeros(len(phrases.terms), np.int64)
    for term, n in got.collect():
        freq[term] = n
    shared.destroy()
    return freq


def _rarest_first(windows: np.ndarray, freq: np.ndarray) -> np.ndarray:
    return np.argsort(freq[windows], axis=1, kind="stable")


def exact_matches(seg: Segment, codes: np.ndarray, windows: np.ndarray, order: np.ndarray):
    """(window number, start) of every occurrence inside one document."""
    n, size = windows.shape
    alive = np.flatnonzero((codes[windows] >= 0).all(axis=1))
    if not len(alive):
        return alive, alive
    rarest = order[alive, 0]
    owner, start = seg.postings(codes[windows[alive, rarest]])
    start = start - rarest[owner]
    owner = alive[owner]
    for step in range(1, size):
        ok = start >= 0
        owner, start = owner[ok], start[ok]
        offset = order[owner, step]
        ok = seg.next_posting(codes[windows[owner, offset]], start + offset) == start + offset
        owner, start = owner[ok], start[ok]
    ok = start >= 0
    owner, start = owner[ok], start[ok]
    ok = seg.document(start) == seg.document(start + size - 1)
    return owner[ok], start[ok]


def near_matches(seg: Segment, codes: np.ndarray, windows: np.ndarray, order: np.ndarray, slack: int):
    """(window number, start) of stretches of up to ``size + slack`` words of one document with all
    terms in any order, each once; a stretch starts at one of the terms and ends with its document
    at the latest."""
    n, size = windows.shape
    span = size + slack
    alive = np.flatnonzero((codes[windows] >= 0).all(axis=1))
    if not len(alive):
        return alive, alive
    owner, at = seg.postings(codes[windows[alive, order[alive, 0]]])
    # a start may lie before several postings of the rarest term
    start = np.repeat(at, span) - np.tile(np.arange(span), len(at))
    pairs = np.unique((np.repeat(alive[owner], span) * seg.size + start)[start >= 0])
    owner, start = pairs // seg.size, pairs % seg.size
    end = np.minimum(start + span, seg.starts[seg.document(start) + 1])
    starts_here = np.zeros(len(owner), bool)
    for step in range(size):
        found = seg.next_posting(codes[windows[owner, order[owner, step]]], start)
        ok = found < end
        starts_here |= found == start
        owner, start, end, starts_here = owner[ok], start[ok], end[ok], starts_here[ok]
    return owner[starts_here], start[starts_here]


# ---------------------------------------------------------------------------- search

HITS = "segment long, doc long, n_near long, spans binary, items array<string>"


def _search_block(index: DataFrame, phrases: Phrases, slack: int | None) -> DataFrame:
    """Hits of one block of items, written before the next block is read, so that one block at
    a time is on the driver and in the workers."""
    freq = term_frequencies(index, phrases)
    orders = {k: _rarest_first(w, freq) for k, w in phrases.windows.items()}
    shared = index.sparkSession.sparkContext.broadcast((phrases, orders))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, orders = shared.value
        for batch in batches:
            for number, *blobs in zip(*(c.to_pylist() for c in batch.columns)):
                if blobs[1] and (rows := list(_segment_hits(number, Segment(*blobs), known, orders, slack))):
                    yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                        ("segment", pa.int64()), ("doc", pa.int64()), ("n_near", pa.int64()),
                        ("spans", pa.binary()), ("items", pa.list_(pa.string()))]))

    hits = stage(index.select("segment", "terms", "counts", "deltas", "starts").mapInArrow(search, HITS), "block-hits")
    shared.destroy()
    return hits


def _segment_hits(number: int, seg: Segment, known: Phrases, orders: dict, slack: int | None) -> Iterator[dict]:
    codes = seg.codes(known.terms)
    edges = np.zeros(seg.size + 1, np.int32)
    items: dict[int, set[int]] = {}
    near: dict[int, int] = {}
    for size, windows in known.windows.items():
        owner, start = exact_matches(seg, codes, windows, orders[size])
        np.add.at(edges, start, 1)
        np.add.at(edges, start + size, -1)
        docs = seg.document(start)
        for doc, window in set(zip(docs.tolist(), owner.tolist())):
            items.setdefault(doc, set()).update(known.owners[size][window])
        if slack is not None:
            for doc in seg.document(near_matches(seg, codes, windows, orders[size], slack)[1]).tolist():
                near[doc] = near.get(doc, 0) + 1
    covered = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
    at = np.searchsorted(covered, seg.starts)
    for doc in sorted(items.keys() | near.keys()):
        inside = covered[at[doc]:at[doc + 1]]
        cut = np.flatnonzero(np.diff(inside) != 1)
        spans = np.column_stack((inside[np.r_[0, cut + 1]], inside[np.r_[cut, -1]] + 1)) if len(inside) else inside
        yield {"segment": number, "doc": doc, "n_near": near.get(doc, 0), "spans": spans.astype("<i4").tobytes(),
               "items": [known.items[i] for i in items.get(doc, ())]}


def matches(index: DataFrame, items: DataFrame, window: int = WINDOW, slack: int | None = None,
            block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_hit`` (words inside exact matches),
    ``items`` (ids, sorted as strings) and, with ``slack``, ``n_near`` proximity matches (null
    without: they were not searched)."""
    hits = None
    for rows in item_blocks(items, block_chars):
        block = _search_block(index, phrases_of(rows, window), slack)
        hits = block if hits is None else hits.unionByName(block)

    @F.pandas_udf("long")
    def covered(spans):
        import pandas as pd

        def length(blobs) -> int:
            pairs = np.concatenate([np.frombuffer(b, "<i4") for b in blobs]).reshape(-1, 2)
            pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
            before = np.r_[0, np.maximum.accumulate(pairs[:, 1])[:-1]] if len(pairs) else pairs[:, 0]
            return int(np.maximum(0, pairs[:, 1] - np.maximum(pairs[:, 0], before)).sum())
        return pd.Series([length(b) for b in spans], dtype="int64")

    # one row per document and block of items that hit it
    hits = hits.groupBy("segment", "doc").agg(
        F.collect_list("spans").alias("spans"), F.sum("n_near").alias("n_near"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    hits = hits.select("segment", "doc", covered("spans").alias("n_hit"), "n_near", "items")
    base = _documents(index).join(hits, ["segment", "doc"], "left")
    none = F.array().cast("array<string>")
    return base.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                       F.when(F.lit(slack is not None), F.coalesce("n_near", F.lit(0))).cast("long").alias("n_near"),
                       F.coalesce("items", none).alias("items"))


def _documents(index: DataFrame) -> DataFrame:
    """(segment, doc, doc_id, n_words) from the segments' document lists."""
    id_type = index.schema["doc_ids"].dataType.elementType
    schema = T.StructType([T.StructField("segment", T.LongType()), T.StructField("doc", T.LongType()),
                           T.StructField("doc_id", id_type), T.StructField("n_words", T.LongType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, ids, starts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, number)), pa.array(np.arange(n)), ids.values,
                     pa.array(np.diff(np.frombuffer(starts, "<i4")).astype(np.int64))], [f.name for f in schema])

    return index.select("segment", "doc_ids", "starts").mapInArrow(rows, schema)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, share: int = SHARE) -> DataFrame:
    """``matches`` of a new index with ``contaminated``: hit words are at least 1 / ``share``."""
    found = matches(build_index(docs), items, window)
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
