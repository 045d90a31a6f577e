"""Periodic runs of words, found by multi-scale minimizers.

A run is a stretch of consecutive words with smallest period q (words q apart are identical),
at least ``min_length`` words and ``EXPONENT`` periods long, that no neighbouring word extends.

* Periods up to ``LAGS``: direct lag scans (word i against word i + q).
* Longer periods by scales (low, top], top about 4/3 low.  At a scale every place has the
  fingerprint of its ``top`` words; the places with the least fingerprint of a window of
  2 (low + 1) - top + 1 places are kept.  Inside a run of period q of the scale the
  fingerprints repeat q apart and nowhere nearer (top >= q words fix the phase), and three
  periods hold a window and its copy q words on.  So the run's kept places come in pairs of
  neighbours with equal fingerprints exactly q apart: one pair of neighbours per kept place is
  looked at, never all pairs.
* Each pair is a seed, extended word by word both ways; seeds inside a stretch that is known
  for the same period are skipped.  A stretch found with a multiple of its period spans the
  same words as the run itself, and the smallest period stays.

Words are numbered exactly, so fingerprints only propose and the words decide.  A task joins
the documents of a batch into one word array with a mark of its own after each, so that short
texts share the work; cost is near linear in the words and memory is linear.

Edge cases: null and empty texts have no words, no runs and an empty collapsed text; ids may
be null; repeated rows are judged alike, each on its own; a text of any length is one array;
extra columns are not read; an empty table gives an empty result.
"""
from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, map_batches, mix

MIN_LENGTH, EXPONENT, LAGS = 24, 3, 16
#: Words of one joined array (a longer text is an array of its own).
CHUNK = 400_000

_FACTOR = np.uint64(0x9FB21C651E98DF25)


def stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the runs of True that have at least ``least`` places."""
    edge = np.flatnonzero(same[1:] != same[:-1]) + 1
    bounds = np.concatenate(([0], edge, [len(same)]))
    begin, end = bounds[:-1], bounds[1:]
    keep = same[begin] & (end - begin >= least)
    return begin[keep], end[keep]


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Places, rising, that are the least (leftmost) of some window of ``width`` neighbours."""
    n = len(keys) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    mask = np.uint64((1 << len(keys).bit_length()) - 1)
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(keys)] = (keys & ~mask) | np.arange(len(keys), dtype=np.uint64)
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = (np.minimum(back[:n], ahead[width - 1:width - 1 + n]) & mask).astype(np.int64)
    return least[np.concatenate(([True], least[1:] != least[:-1]))]


def extended(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """(begin, end) of the places around ``at`` whose word is the word ``period`` later."""
    def reach(here: np.ndarray, there: np.ndarray) -> int:
        done, step = 0, 64
        while done < len(here):
            unlike = np.flatnonzero(here[done:done + step] != there[done:done + step])
            if len(unlike):
                return done + int(unlike[0])
            done, step = min(done + step, len(here)), step * 2
        return done

    end = at + reach(words[at:len(words) - period], words[at + period:])
    begin = at - reach(words[:at][::-1], words[period:at + period][::-1])
    return begin, end


def seeds(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, low: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(document, place in it, distance) of equal neighbours, scale after scale above ``low``."""
    documents = np.arange(len(starts))
    own, level, held = words, None, 1
    while True:
        need = EXPONENT * (low + 1)
        able = sizes[documents] >= need
        if not able.any():
            return
        if level is None or sizes[documents[able]].sum() < 0.7 * len(own):
            documents = documents[able]
            own = np.concatenate([words[starts[k]:starts[k] + sizes[k] + 1] for k in documents])
            firsts = np.concatenate(([0], np.cumsum(sizes[documents] + 1)[:-1]))
            level, held = mix(own.astype(np.uint64) * _FACTOR + np.uint64(1)), 1
        top = max(low + 1, low * 4 // 3)
        while 2 * held <= top:  # fingerprints of twice the words from those of two neighbours
            level = mix(level[:len(level) - held] * _FACTOR + level[held:])
            held *= 2
        n = len(own) - top + 1
        keys = mix(level[:n] * _FACTOR + level[top - held:top - held + n] + np.uint64(top))
        kept = window_minima(keys, 2 * (low + 1) - top + 1)
        found = keys[kept]
        order = np.argsort(found, kind="stable")
        place, found = kept[order], found[order]
        gap = place[1:] - place[:-1]
        pair = np.flatnonzero((found[1:] == found[:-1]) & (gap > low) & (gap <= top))
        if len(pair):
            at = place[pair]
            k = np.searchsorted(firsts, at, side="right") - 1
            yield documents[k], at - firsts[k], gap[pair]
        low = top


def runs_of(texts: list[list[bytes]], min_length: int = MIN_LENGTH, lags: int = LAGS) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of every document, by start and period."""
    number: dict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    words = np.empty(int(sizes.sum()) + len(sizes), np.int64)
    for k, text in enumerate(texts):
        words[starts[k]:starts[k] + sizes[k]] = np.fromiter(map(number.__getitem__, text), np.int64, len(text))
    words[starts + sizes] = -1 - np.arange(len(sizes))
    best: dict[tuple[int, int, int], int] = {}

    def note(document: int, start: int, length: int, period: int) -> None:
        key = (document, start, length)
        best[key] = min(best.get(key, period), period)

    for q in range(1, lags + 1):
        if len(words) <= q:
            break
        begin, end = stretches(words[q:] == words[:-q], max(min_length - q, (EXPONENT - 1) * q))
        document = np.searchsorted(starts, begin, side="right") - 1
        for k, b, e in zip(document.tolist(), begin.tolist(), end.tolist()):
            note(k, b - int(starts[k]), e - b + q, q)
    for documents, places, periods in seeds(words, starts, sizes, lags):
        known = (-1, -1, -1)
        for i in np.lexsort((places, periods, documents)).tolist():
            k, at, q = int(documents[i]), int(places[i]), int(periods[i])
            if (k, q) == known[:2] and at < known[2]:
                continue
            begin, end = extended(words[starts[k]:starts[k] + sizes[k]], at, q)
            known = (k, q, end)
            if end - begin + q >= max(min_length, EXPONENT * q):
                note(k, begin, end - begin + q, q)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for (k, start, length), period in best.items():
        out[k].append((start, length, period))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def kept_words(text: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words that no run contains after its first period."""
    if not runs:
        return text
    change = np.zeros(len(text) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [w for w, inside in zip(text, np.cumsum(change[:-1]).tolist()) if not inside]


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, lags: int = LAGS) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``runs`` (start, length, period in words; by
    start, then period) and ``collapsed``, the words left joined by one space."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T._parse_datatype_string(RUNS)),
                           T.StructField("collapsed", T.StringType())])
    names = [f.name for f in schema]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def judged(rows: list[int], texts: list[list[bytes]]) -> pa.RecordBatch:
            found = runs_of(texts, min_length, lags)
            return pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([[dict(zip(("start", "length", "period"), r)) for r in f] for f in found], kind),
                 pa.array([b" ".join(kept_words(t, f)) for t, f in zip(texts, found)], pa.binary()).cast(pa.string())],
                names)

        for batch in batches:
            rows, texts, held = [], [], 0
            for k, text in enumerate(as_bytes(batch.column(1))):
                text = text.split()  # bytes split at the six ASCII blanks, and at nothing else
                if texts and held + len(text) > CHUNK:
                    yield judged(rows, texts)
                    rows, texts, held = [], [], 0
                rows.append(k)
                texts.append(text)
                held += len(text) + 1
            if texts:
                yield judged(rows, texts)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def with_planted_period(docs: DataFrame) -> DataFrame:
    """``docs`` (``doc_id``, ``text``) in which every text whose id hashes to 0 of 10 is made periodic
    from one word on: with h the crc32 of the decimal id, g = h // 10, n words, a = g % n and
    p = 1 + (n - a) // (3 + g % 8), words i >= a become word a + (i - a) % p.  A null id plants nothing."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("text", T.StringType())])

    def plant(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for i, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
            h = 1 if i is None else zlib.crc32(str(i).encode())
            words = text.split() if h % 10 == 0 else []
            if words:
                g, n = h // 10, len(words)
                a = g % n
                period = words[a:a + 1 + (n - a) // (3 + g % 8)]
                text = b" ".join(words[:a] + (period * ((n - a) // len(period) + 1))[:n - a])
            out.append(text)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary()).cast(pa.string())],
                                          [f.name for f in schema])

    return map_batches(docs.select("doc_id", "text"), plant, schema)


def best_run(runs: Column) -> Column:
    """The run with the greatest exact length / period; the first of equals (smallest start, then
    period, as ``runs`` is sorted); null without runs."""
    def better(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    return F.reduce(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)
