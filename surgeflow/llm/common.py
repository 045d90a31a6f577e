"""Shared helpers: written stage tables, word hashing and tokenizer ids in Arrow tasks."""
from __future__ import annotations

import html
import json
import os
import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

#: Deletes everything but word bytes: a-z (A-Z lowered), 0-9 and all bytes of non-ASCII characters.
WORD_BYTES = bytes(
    b | 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))
#: Entries after which a worker's word cache starts afresh.
CACHE_WORDS = 150_000
#: Decimal character references with more digits than Python turns into a number.
LONG_REFERENCE = re.compile(r"&#([0-9]{1000,});?")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str, partition_by: Iterable[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: one evaluation, durable
    when executors are lost, columns still pruned and filters still pushed."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    for columns in [list(partition_by)]:
        writer = writer.partitionBy(*columns) if columns else writer
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_rows(docs: DataFrame, name: str, keep: Iterable[str] = ("doc_id", "text")) -> DataFrame:
    """Stage ``docs`` with a unique ``row`` number, so repeated and null ids stay apart."""
    return stage(docs.select(*keep).withColumn("row", F.monotonically_increasing_id()), name)


def unescape(text: str) -> str:
    """``html.unescape`` for references of any length (too great a number is U+FFFD)."""
    def shorter(found: re.Match) -> str:
        digits = found[1].lstrip("0") or "0"
        return f"&#{digits};" if len(digits) < 8 else "\ufffd"

    return html.unescape(LONG_REFERENCE.sub(shorter, text) if "&#" in text else text)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [b or b"" for b in column.cast(pa.large_binary()).to_pylist()]


def map_batches(df: DataFrame, fn, schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` for a function of one record batch that returns one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)
        forget_words()
    return df.mapInArrow(run, schema)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words: runs of ASCII letters, digits and non-ASCII characters."""
    return text.translate(WORD_BYTES).split()


def forget_words() -> None:
    """Empty the worker's word cache at the end of a task; the worker lives on for later stages."""
    _HASHES.clear()


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of ``text`` in order."""
    words = words_of(text)
    if len(_HASHES) > CACHE_WORDS:
        _HASHES.clear()
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64-bit output (wraps on purpose)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def gram_hashes(h: np.ndarray, offsets: tuple[int, ...]) -> np.ndarray:
    """Order-dependent hashes of the words at ``offsets`` from every start (empty if too short)."""
    n = len(h) - max(offsets)
    if n <= 0:
        return h[:0]
    acc = np.full(n, len(offsets) * 2 + 1, np.uint64)
    for off in offsets:
        acc = acc * np.uint64(0x9FB21C651E98DF25) + h[off:off + n]
        acc = acc ^ (acc >> np.uint64(31))
    return mix(acc)


#: Fixed value: the pre-tokeniser's pattern of the word vocabulary, and the same for lower-case ASCII.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
#: Signs, letters and signs: lower-case letters that normalisation leaves alone; an apostrophe only
#: after them, because "'s" before letters is a part of its own.
SIMPLE = (r"^(?P<head>[!-&(-/:-@\[-`{-~]*)(?P<base>[a-z\x{df}-\x{f6}\x{f8}-\x{ff}\x{3ac}-\x{3ce}\x{430}-\x{45f}]*)"
          r"(?P<tail>[!-/:-@\[-`{-~]*)$")
#: Bytes of text encoded at a time, and of pieces and ids that a worker's cache holds.
SLICE_BYTES, CACHE_BYTES = 8 << 20, 32 << 20


class TokenIds:
    """Ids of texts by the plain tokenizer call, with each distinct part of words encoded once.

    The word vocabulary's normaliser and pre-tokeniser never join characters over white space, so
    the ids of a text are those of its pieces between blanks in order.  Arrow splits a slice
    into pieces, numbers the distinct ones and cuts the ``SIMPLE`` ones into three parts; the
    cache maps a part to its ids in one flat array, and new parts go to the tokenizer as one
    joined text, cut at the ids that end a word.  Other ASCII pieces are the sequence of their
    parts too; pieces with other letters and those that hold a special marker go to the
    tokenizer as they are.  A full cache forgets what the fewest slices used.

    A vocabulary with another pattern is applied to whole texts.
    """

    def __init__(self, path: str, cache: int = 500_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        made = json.loads(self.tokenizer.to_str())
        split = ((made.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        self.by_pieces = (split.get("pattern") or {}).get("Regex") == WORD_PATTERN
        self.markers = [t["content"] for t in made.get("added_tokens") or []]
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.cache = cache
        self._start_anew()

    def _start_anew(self) -> None:
        # part 0 is the empty one; the ids of part n are flat[bounds[n]:bounds[n + 1]]
        self.number: dict[str, int] = {"": 0}
        self.flat, self.bounds, self.uses = np.zeros(0, "<u4"), np.zeros(2, np.int64), np.zeros(1, np.int64)
        self.held = 0

    def _ids(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _put(self, parts: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Add new distinct parts with their joined ids."""
        first = len(self.number)
        self.number.update(zip(parts, range(first, first + len(parts))))
        self.flat = np.concatenate((self.flat, ids))
        self.bounds = np.concatenate((self.bounds, self.bounds[-1] + np.cumsum(sizes)))
        self.uses = np.concatenate((self.uses, np.zeros(len(parts), np.int64)))
        self.held += sum(map(len, parts)) + 4 * len(ids)

    def _evict(self) -> None:
        """Keep the half of the parts that most slices used, without those that one did, and age the counts."""
        order = np.argsort(-self.uses, kind="stable")[:len(self.uses) // 2]
        kept = np.zeros(len(self.uses), bool)
        kept[order[self.uses[order] > 1]] = True
        kept[0] = False
        parts = [part for part, k in zip(self.number, kept.tolist()) if k]
        at, uses = np.flatnonzero(kept), self.uses[kept] // 2
        ids, sizes = gathered(self.flat, self.bounds[at], self.bounds[at + 1] - self.bounds[at])
        self._start_anew()
        self._put(parts, ids, sizes)
        self.uses[1:] = uses

    def _learn(self, parts: list[str]) -> None:
        """Add the parts that are new; each is one word or one run of signs."""
        parts = [p for p in parts if p not in self.number]
        for at in range(0, len(parts), 4096):
            some = parts[at:at + 4096]
            ids = np.asarray(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            sizes = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
            if len(sizes) != len(some):  # letters that the tokenizer's version of Unicode does not know
                each = [self._ids(p) for p in some]
                ids, sizes = np.concatenate(each), np.array([len(i) for i in each])
            self._put(some, ids, sizes)

    def _learn_whole(self, pieces: list[str]) -> None:
        """Add pieces that are not ``SIMPLE``."""
        pieces = [p for p in pieces if p not in self.number]
        made = [None if not p.isascii() or any(m in p for m in self.markers) else ASCII_PARTS.findall(p.lower())
                for p in pieces]
        self._learn(list(dict.fromkeys(w for parts in made for w in parts or ())))
        # a piece may be a part as well
        left = [(p, parts) for p, parts in zip(pieces, made) if p not in self.number]
        each = []
        for p, parts in left:
            if parts is None:
                each.append(self._ids(p))
            else:
                at = [self.number[w] for w in parts]
                each.append(np.concatenate([self.flat[self.bounds[n]:self.bounds[n + 1]] for n in at]))
        if left:
            self._put([p for p, _ in left], np.concatenate(each), np.array([len(i) for i in each]))

    def _numbers(self, pieces: pa.Array) -> np.ndarray:
        """Numbers of the three parts of each distinct piece (a row of parts or a whole piece)."""
        cut = pc.extract_regex(pc.ascii_lower(pieces), SIMPLE)
        head, base, tail = (pc.struct_field(cut, i) for i in range(3))
        # signs alone are one run
        empty = [pc.equal(pc.binary_length(x), 0) for x in (head, base, tail)]
        simple = pc.and_(pc.is_valid(cut), pc.or_(pc.invert(empty[1]), pc.or_(empty[0], empty[2])))
        for marker in self.markers:
            simple = pc.and_(simple, pc.invert(pc.match_substring(pieces, marker)))
        simple = pc.fill_null(simple, False).to_numpy(zero_copy_only=False)
        at, rest = np.flatnonzero(simple), np.flatnonzero(~simple)
        parts = pa.concat_arrays([x.take(pa.array(at)) for x in (head, base, tail)]).dictionary_encode()
        words, others = parts.dictionary.to_pylist(), pieces.take(pa.array(rest)).to_pylist()
        if len(self.number) + len(words) + len(others) > self.cache or self.held > CACHE_BYTES:
            self._evict()
        self._learn(words)
        self._learn_whole(others)
        out = np.zeros((len(pieces), 3), np.int64)
        known = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        out[at] = known[parts.indices.to_numpy()].reshape(3, -1).T
        out[rest, 0] = np.fromiter(map(self.number.__getitem__, others), np.int64, len(others))
        self.uses[known] += 1
        self.uses[out[rest, 0]] += 1
        return out

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        pieces = pc.ascii_split_whitespace(texts)
        offsets = pieces.offsets.to_numpy()
        words = pieces.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        parts = self._numbers(words.dictionary)
        size = self.bounds[parts + 1] - self.bounds[parts]
        flat, _ = gathered(self.flat, self.bounds[parts].ravel(), size.ravel())
        size = size.sum(axis=1)
        at = words.indices.to_numpy()
        ids, sizes = gathered(flat, (np.cumsum(size) - size)[at], size[at])
        return ids, np.concatenate(([0], np.cumsum(sizes)))[offsets - offsets[0]]

    def encode(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids, bounds) for slices of a string column: the ids of row first + k are
        ids[bounds[k]:bounds[k + 1]]; null counts as empty."""
        column = column.fill_null("")
        if not self.by_pieces:
            for at, text in enumerate(column.to_pylist()):
                ids = self._ids(text)
                yield at, ids, np.array([0, len(ids)])
            return
        ends = np.cumsum(pc.binary_length(column).to_numpy().astype(np.int64))
        first = 0
        while first < len(column):
            before = ends[first - 1] if first else 0
            after = max(first + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
            yield first, *self._slice(column.slice(first, after - first))
            first = after

    def of(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian bytes."""
        return [ids[a:b].tobytes() for _, ids, bounds in self.encode(pa.array(texts, pa.string()))
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def gathered(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the stretches of ``flat`` of the given beginnings and sizes, joined; the sizes)."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(begin - (ends - size), size) + np.arange(total)], size


_TOKENS: dict[str, TokenIds] = {}


def token_ids(path: str) -> TokenIds:
    """The worker's cache for the vocabulary file at ``path`` (each machine has the file)."""
    if path not in _TOKENS:
        _TOKENS[path] = TokenIds(path)
    return _TOKENS[path]


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")
