import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import BLANK, EDGE_DOCS, LONG, SF0001, same, table  # noqa: F401
from pyspark.sql import functions as F

from surgeflow.llm import cuckoo, decontam, line_runs, ngram_join, packing, queries, suffix_index, token_counts
from surgeflow.llm.common import TokenIds, default_vocabulary, read_table, token_ids, words_of

DOCS = "doc_id long, text string"


def plain_ids(text):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(default_vocabulary())
    return t.encode(text or "", add_special_tokens=False).ids


def test_cached_tokens_equal_plain_ones(spark):
    texts = [t for _, t in EDGE_DOCS] + [r.text for r in read_table(spark, SF0001, "documents").limit(60).collect()]
    got = token_ids(default_vocabulary()).of(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [plain_ids(t) for t in texts]


#: Letters that change under lower-casing or composition, marks, blanks, signs, markers.
ODD = [*"abcABCJHTWYK'.,;!-*$%#019 \t\n\x0b\x0c\x1c\x85\xa0\u2003\u200b\xadéÉİıſßẞΣσςÅåǰẖẗªʰﬁﬀ中。한कｶ",
       "\u0301", "\u0307", "\u030c", "\u0331", "\u0308", "\u030a", "\u0958", "\u1112", "\u1161", "\u11ab", "\u0661", "\u2167",
       "\u212a", "\u212b", "\ufeff", "\ufffd", "\U0001f600", "\U00010400", "\U0001e900", "'s", "'LL", "'re",
       "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>"]


@pytest.mark.parametrize("seed", range(2))
def test_ids_of_odd_texts(seed):
    from tokenizers import Tokenizer
    rng = random.Random(seed)
    plain, cached = Tokenizer.from_file(default_vocabulary()), TokenIds(default_vocabulary(), cache=3000)
    for _ in range(50):
        texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 12))) for _ in range(700)]
        texts += ["".join(chr(rng.choice([rng.randrange(32, 0x530), rng.randrange(32, 0xd800), rng.randrange(0xe000, 0x2ffff)]))
                          for _ in range(rng.randint(1, 6))) + rng.choice(["", ".", ",", " a"]) for _ in range(150)]
        texts += [" ".join("".join(rng.choice("abcdefghijABC',.") for _ in range(rng.randint(1, 8))) for _ in range(6))
                  for _ in range(150)]
        expected = plain.encode_batch(texts, add_special_tokens=False)
        for text, got, right in zip(texts, cached.of(texts), expected):
            assert np.frombuffer(got, "<u4").tolist() == right.ids, ascii(text)
    assert len(cached.number) < 10_000


def test_another_vocabulary_is_applied_to_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer
    path, texts = public_tokenizers.path("byte_bpe_50k.json"), ["two  blanks\n and one ", "", "İ. x"]
    expected = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(g, "<u4").tolist() for g in TokenIds(path).of(texts)] == expected


# ------------------------------------------------------------------------ exact dedup

def brute_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(BLANK, "", t or "")].append((-len(t or ""), i is None, i or 0, i))
    return {hashlib.sha256(k.encode()).hexdigest(): (min(v)[3], len(v)) for k, v in groups.items()}


def test_exact_dedup_edges(table):
    rows = [(r.digest.hex(), r.doc_id, r.keep_id, r.group_size, r.kept)
            for r in cuckoo.exact_groups(table(EDGE_DOCS, DOCS), bucket_keys=3).collect()]
    expected = brute_exact(EDGE_DOCS)
    assert len(rows) == len(EDGE_DOCS)
    assert {d: (k, n) for d, _, k, n, _ in rows} == expected
    assert Counter(d for d, *_, kept in rows if kept) == Counter(list(expected))  # exactly one row stays
    assert cuckoo.exact_groups(table([], DOCS)).count() == 0



def test_cuckoo_filter_insert_delete_overflow():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 2**63, 3000).astype(np.uint64)
    f = cuckoo.CuckooFilter(4096)
    assert f.insert(keys) and f.contains(keys).all()
    f.delete(keys[:1500])
    assert f.contains(keys[1500:]).all()
    assert f.contains(keys[:1500]).mean() < 0.02
    assert not cuckoo.CuckooFilter(64).insert(keys)


@pytest.mark.parametrize("seed", range(4))
def test_cuckoo_filter_holds_all_it_accepts(seed):
    rng = np.random.default_rng(seed)
    f, held = cuckoo.CuckooFilter(4096), np.zeros(0, np.uint64)
    while len(held) < 3700:  # 90 % full, in uneven steps
        keys = rng.integers(0, 2**63, min(3700 - len(held), int(rng.integers(1, 900)))).astype(np.uint64)
        assert f.insert(keys)
        held = np.concatenate((held, keys))
        assert f.contains(held).all() and np.count_nonzero(f.table) == len(held)


def test_cuckoo_index_splits_its_buckets(spark):
    def digests(numbers):
        return spark.createDataFrame([(hashlib.sha256(str(i).encode()).digest(),) for i in numbers], "digest binary")
    index = cuckoo.CuckooIndex(spark, bucket_keys=100)
    sizes = []
    for first in (0, 90, 500, 1200):
        found = index.insert(digests(range(first, first + 600)))
        assert found.where("held").count() == max(0, sizes[-1][1] - first if sizes else 0)
        sizes.append((index.buckets, first + 600))
    assert [b for b, _ in sizes] == sorted(b for b, _ in sizes) and index.buckets * 100 >= index.size == 1700  # 1100 to 1199 never came
    index.delete(digests(range(100)))
    assert index.size == 1600
    again = index.lookup(digests(range(1900))).where("held")
    assert again.count() == 1600 == index.live().count()
    assert index.filters.groupBy("bucket").count().where("count > 1").isEmpty()


def test_cuckoo_index_grows_and_forgets(spark):
    def digests(numbers):
        return spark.createDataFrame([(hashlib.sha256(str(i).encode()).digest(),) for i in numbers], "digest binary")
    index = cuckoo.CuckooIndex(spark, bucket_keys=4000)
    assert index.insert(digests(range(6000))).where("held").count() == 0
    assert index.filters.where("overflow").count() == 0  # overflown filters were rebuilt
    assert index.insert(digests(range(5990, 6010))).where("held").count() == 10
    index.delete(digests([1, 2, 99_999]))
    assert index.live().count() == 6008
    assert index.insert(digests([1, 3])).where("held").count() == 1
    assert index.live().count() == 6009


# -------------------------------------------------------------------------- line dedup

def brute_lines(rows, min_chars=20, min_docs=3):
    def key(line):
        return line.strip(" \t\n\v\f\r").translate({c: c + 32 for c in range(65, 91)})
    docs = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                docs[key(line)].add(i)
    keep = {k: max((i for i in v if i is not None), default=None) for k, v in docs.items() if len(v) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if key(x) not in keep or keep[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return out


@pytest.mark.parametrize("batches", [1, 4])
def test_line_dedup_edges(table, batches):
    extra = [(100 + i, f"common line number {i % 5} of the batch test\nown {i}\nown {i}") for i in range(23)]
    rows = EDGE_DOCS + extra
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.text)
           for r in line_runs.drop_lines(table(rows, DOCS), batches=batches).collect()]
    same(got, brute_lines(rows))
    assert line_runs.drop_lines(table([], DOCS)).count() == 0


def test_line_runs_compact(spark):
    runs = line_runs.LineRuns(spark)
    for k in range(5):
        runs.add(spark.createDataFrame([(10 - k, b"a"), (10 - k, bytes([k]))], "doc_id long, key binary"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    counts = {bytes(r.key): (r.keeper, r.n_docs) for r in runs.counts().collect()}
    assert counts[b"a"] == (10, 5) and counts[bytes([4])] == (6, 1)


# ------------------------------------------------------------------------ token counts

def test_length_histogram_and_suffix_sums(table):
    lengths = [len(plain_ids(t)) for _, t in EDGE_DOCS]
    limits = token_counts.context_table(token_counts.length_histogram(table(EDGE_DOCS, DOCS)))
    for r in limits.collect():
        limit = r.context_limit
        assert r.n_docs == lengths.count(limit)
        assert r.n_docs_over == sum(x > limit for x in lengths)
        assert r.tokens_over == sum(x for x in lengths if x > limit)
        assert r.tokens_truncated == sum(min(x, limit) for x in lengths)
        assert (r.total_docs, r.total_tokens) == (len(lengths), sum(lengths))
    q = token_counts.quantiles(limits, [0.5, 1.0]).first()
    assert (q["p0.5"], q["p1"]) == (sorted(lengths)[(len(lengths) - 1) // 2], max(lengths))
    asked = table([(3,), (10**7,), (3,)], "context_limit long", extra=False)
    assert {r.context_limit: r.tokens_truncated for r in token_counts.totals_at(limits, asked).collect()} == {
        3: sum(min(x, 3) for x in lengths), 10**7: sum(lengths)}
    assert token_counts.length_histogram(table([], DOCS)).count() == 0
    report = token_counts.context_report(token_counts.length_histogram(table(EDGE_DOCS, DOCS)), [1, 3, 10**6], [0.5, 0.99])
    rows = {r.context_limit: r for r in report.collect()}
    assert set(rows) == {*lengths, 1, 3, 10**6}
    for limit, r in rows.items():
        assert r.n_docs == lengths.count(limit) and r.n_docs_over == sum(x > limit for x in lengths)
        assert r.tokens_truncated == sum(min(x, limit) for x in lengths)
        assert abs(r.docs_within - sum(x <= limit for x in lengths) / len(lengths)) < 1e-12
        assert (r.length_p50, r.length_p99) == (sorted(lengths)[(len(lengths) - 1) // 2], max(lengths))
    empty = token_counts.context_report(token_counts.length_histogram(table([], DOCS)), [4], [0.5]).collect()
    assert [(r.context_limit, r.n_docs_over, r.docs_within, r.length_p50) for r in empty] == [(4, 0, None, None)]


def test_op10_against_plain_token_counts(spark):
    lengths = [len(plain_ids(r.text)) for r in read_table(spark, SF0001, "documents").collect()]
    rows = queries.op10_token_counts(spark, SF0001).collect()
    assert {r.context_limit for r in rows} == {*lengths, *(2**k for k in range(7, 21))}
    ordered = sorted(lengths)
    for r in rows:
        assert r.n_docs_over == sum(x > r.context_limit for x in lengths) and r.n_docs == lengths.count(r.context_limit)
        assert r.tokens_over == sum(x for x in lengths if x > r.context_limit)
        assert r.tokens_truncated == sum(min(x, r.context_limit) for x in lengths)
        for p in (5, 25, 50, 75, 95, 99):
            assert r[f"length_p{p}"] == ordered[-(-p * len(lengths) // 100) - 1]


# ----------------------------------------------------------------------------- packing

def check_packing(rows, docs, capacity):
    texts = sorted(((i, t) for i, t in docs), key=repr)
    pieces = defaultdict(list)
    bins = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        bins[r.sequence_id].append((r.offset, r.length))
    expected = defaultdict(list)
    for i, t in texts:
        ids = plain_ids(t) + [0]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            expected[i].append((k, at, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes())))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in expected.items()}
    for b in bins.values():
        end = 0
        for offset, length in sorted(b):
            assert offset == end
            end += length
        assert end <= capacity
    return len(bins), sum(r.length for r in rows)


def test_packing_edges(table):
    rows = packing.pack(table(EDGE_DOCS, DOCS), capacity=64, shard=40).collect()
    n, total = check_packing(rows, EDGE_DOCS, 64)
    assert n <= -(-total // 64) + 2
    assert packing.pack(table([], DOCS)).count() == 0


def test_packing_table_is_near_the_least(spark):
    docs = read_table(spark, SF0001, "documents")
    n, total = check_packing(packing.pack(docs).collect(), [tuple(r) for r in docs.select("doc_id", "text").collect()],
                             2048)
    assert n <= 1.02 * total / 2048 + 1


def test_crossover_keeps_every_piece_once():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 900, 300).tolist()
    first = packing.evolve(sizes, [], 1000, rng, 0, 3)
    for _ in range(5):
        child = packing.mutate(packing.crossover(first[0], first[2], sizes, 1000, rng), sizes, 1000, rng)
        assert sorted(p for b in child for p in b) == list(range(300))
        assert max(sum(sizes[p] for p in b) for b in child) <= 1000
    assert packing._decode(packing._encode(first[0], 300)) == [sorted(b) for b in first[0]]
    assert packing._decode(b"") == []


def test_evolution_goes_on_where_the_bound_is_not_met(monkeypatch):
    made = []
    crossover = packing.crossover
    monkeypatch.setattr(packing, "crossover", lambda *a: made.append(crossover(*a)) or made[-1])
    sizes = [600 + k for k in range(30)]     # no two share a bin, so the bound of 19 is out of reach
    best = packing.evolve(sizes, [], 1000, np.random.default_rng(0), packing.GENERATIONS, packing.POPULATION)
    assert len(made) == packing.GENERATIONS >= 10 and len(best) == packing.POPULATION >= 6
    assert [len(b) for b in best] == [30] * len(best)
    made.clear()
    packing.evolve([500] * 30, [], 1000, np.random.default_rng(0), packing.GENERATIONS, packing.POPULATION)
    assert not made                          # 15 full bins cannot be bettered


# --------------------------------------------------------------------- decontamination

def brute_hits(docs, items, window=13):
    grams = defaultdict(set)
    for item, text in items:
        w = words_of((text or "").encode())
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            grams[tuple(w[k:k + size])].add("null" if item is None else str(item))
    out = []
    for i, t in docs:
        w, hit, found = words_of((t or "").encode()), set(), set()
        for size in {len(g) for g in grams}:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in grams:
                    hit.update(range(k, k + size))
                    found |= grams[tuple(w[k:k + size])]
        out.append((i, len(w), len(hit), sorted(found)))
    return out


ITEMS = [(1, "Brown fox, jumps!"), (1, "lazy dog"), (None, "one"), (3, None), (4, "..."),
         (5, " ".join(f"word{i} piece{i}" for i in range(25))), (6, "absent words here"), (5, "lazy dog")]


@pytest.mark.parametrize("block", [10, 1 << 20])
def test_decontamination_edges(table, monkeypatch, block):
    monkeypatch.setattr(decontam, "SEGMENT_WORDS", 50)
    docs, items = table(EDGE_DOCS, DOCS), table(ITEMS, "item_id long, text string")
    got = decontam.matches(decontam.build_index(docs), items, block_chars=block)
    same([(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got.collect()], brute_hits(EDGE_DOCS, ITEMS))
    assert decontam.decontaminate(table([], DOCS), items).count() == 0
    none = decontam.decontaminate(docs, table([], "item_id long, text string")).collect()
    assert len(none) == len(EDGE_DOCS) and not any(r.contaminated or r.n_hit for r in none)


def test_item_blocks_hold_copies_once(table):
    rows = [(k, f"text {k} " + "x " * 50) for k in range(40)] + [(7, "copied item " * 10)] * 400 + [(None, None)] * 3
    items = table(rows, "item_id long, text string")
    blocks = list(decontam.item_blocks(items, block_chars=600))
    assert max(sum(len(t or "") for _, t in b) for b in blocks) < 5 * 600
    same([r for b in blocks for r in b], list(set(rows)))


def test_no_proximity_count_without_a_search(table):
    docs, items = table([(1, "a b c"), (2, "x")], DOCS), table([(1, "a b c")], "item_id long, text string")
    assert [r.n_near for r in decontam.decontaminate(docs, items).collect()] == [None, None]
    got = decontam.matches(decontam.build_index(docs), items, slack=0).collect()
    assert {r.doc_id: r.n_near for r in got} == {1: 1, 2: 0}


def test_proximity_matches(table):
    docs = table([(1, "a x b y c"), (2, "a x x x x b c"), (3, "c b a"), (4, "a b d")], DOCS)
    items = table([(1, "a b c")], "item_id long, text string")
    got = decontam.matches(decontam.build_index(docs), items, slack=2).collect()
    assert {r.doc_id: r.n_near > 0 for r in got} == {1: True, 2: False, 3: True, 4: False}


def brute_proximity(docs, items, slack, window=13):
    grams = set()
    for _, text in items:
        w = words_of((text or "").encode())
        size = min(window, len(w))
        grams |= {tuple(w[k:k + size]) for k in range(len(w) - size + 1 if size else 0)}
    out = []
    for i, t in docs:
        w = words_of((t or "").encode())
        out.append((i, sum(w[k] in g and set(g) <= set(w[k:k + len(g) + slack]) for g in grams for k in range(len(w)))))
    return out


@pytest.mark.parametrize("segment", [7, 1 << 20])
def test_proximity_ends_with_its_own_document(table, monkeypatch, segment):
    monkeypatch.setattr(decontam, "SEGMENT_WORDS", segment)
    rng = np.random.default_rng(4)
    docs = [(1, "c b a"), (2, "a b c"), (3, ""), (4, "x a"), (5, "b c x"), (6, "x x x x c x b a"), (7, "a a x b c"),
            (8, None), (9, "b c"), (10, "a b x x c")]
    docs += [(20 + k, " ".join(rng.choice(list("abcdex"), rng.integers(0, 9)))) for k in range(60)]
    items = [(1, "a b c"), (2, "d e"), (3, "a a d"), (4, "c b a e d")]
    index = decontam.build_index(table(docs, DOCS).repartition(1))
    for slack in (0, 2):
        got = decontam.matches(index, table(items, "item_id long, text string"), window=4, slack=slack).collect()
        same([(r.doc_id, r.n_near) for r in got], brute_proximity(docs, items, slack, window=4))


# ------------------------------------------------------------------------ n-gram join

def brute_near(docs, threshold=0.8):
    sets = [frozenset(ngram_join.shingles((t or "").encode()).tolist()) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    links = []
    for a in range(len(docs)):
        near = {b for b in range(len(docs)) if b != a and (sets[a] == sets[b] or (
            sets[a] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])))}
        links.append(len({sets[b] for b in near} - {sets[a]}))
        for b in near:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return [find(a) for a in range(len(docs))], links


@pytest.mark.parametrize("block", [7, 1024])
def test_near_classes_against_brute_force(table, block):
    rng = np.random.default_rng(1)
    base = [f"w{k}" for k in rng.integers(0, 5000, 120)]
    docs = list(EDGE_DOCS)
    for i in range(40):  # one large group of near copies and their exact copies
        words = list(base)
        for k in rng.integers(0, 120, i % 4):
            words[k] = f"new{rng.integers(0, 3)}"
        docs.append((1000 + i, " ".join(words)))
    docs += [(2000 + i, " ".join(f"r{k}" for k in rng.integers(0, 10**6, 30))) for i in range(20)]
    found = ngram_join.near_classes(table(docs, DOCS).repartition(1), block=block).collect()
    # rows are numbered in the order of the single partition
    order = sorted(found, key=lambda r: r.row)
    texts = defaultdict(list)
    for i, t in docs:
        texts[i].append(t)
    listed = [(r.doc_id, texts[r.doc_id].pop(0)) for r in order]
    classes, links = brute_near(listed)
    place = {r.row: k for k, r in enumerate(order)}
    assert [place[r.class_row] for r in order] == classes
    assert [r.n_links for r in order] == links
    assert [r.class_size for r in order] == [classes.count(c) for c in classes]
    assert ngram_join.near_classes(table([], DOCS)).count() == 0


def chain(n, step=5, size=100):
    """Texts that each overlap their neighbours by 0.8 and more, and nothing further away."""
    words = [f"c{k}" for k in range(n * step + size)]
    return [(i, " ".join(words[i * step:i * step + size])) for i in range(n)]


@pytest.mark.parametrize("row_cost", [0, 64])
def test_a_long_chain_is_verified_by_buckets(table, row_cost):
    docs = chain(150) + [(1000 + i, f"x{i % 2} " + " ".join(f"v{k}" for k in range(60))) for i in range(5)]
    found = sorted(ngram_join.near_classes(table(docs, DOCS).repartition(1), row_cost=row_cost, block=16).collect(),
                   key=lambda r: r.doc_id)
    classes, links = brute_near(docs)
    assert [r.n_links for r in found] == links
    firsts = {}
    for r, c in zip(found, classes):
        assert firsts.setdefault(c, r.class_id) == r.class_id
    assert len(firsts) == len(set(classes)) == 2


def test_rows_that_share_centres_add_one_edge_each(table):
    # row r is in the bucket of band k from row k on: the centres of the bands differ
    reps = table([(r, 1, [k if r >= k else -100 * r - k for k in range(6)]) for r in range(40)],
                 "row long, n_grams long, bands array<long>")
    edges = ngram_join.edges_of(reps, ngram_join.band_stars(reps))
    assert edges.count() == 39
    assert {tuple(r) for r in ngram_join.components(edges).collect()} == {(r, 0) for r in range(40)}


def test_units_of_a_chain_are_buckets_and_of_copies_one(table):
    bands, rows = ngram_join.bands_for(0.8, 0.9999)
    group = [(5000 + i, " ".join(f"n{k}" if k != i else "odd" for k in range(200))) for i in range(30)]
    docs = table(chain(150) + group, DOCS).withColumn("row", F.col("doc_id"))
    reps = ngram_join.stage(ngram_join.signatures(docs, 5, bands, rows), "test-reps")
    got = ngram_join.units_of(reps, ngram_join.band_stars(reps), 0).collect()
    largest = max(u.members for r in got if r.row < 5000 for u in r.units)
    assert largest < 30 and all(u.band >= 0 for r in got if r.row < 5000 for u in r.units)
    assert all([(u.band, u.members) for u in r.units] == [(-1, 30)] for r in got if r.row >= 5000)


def test_recall_on_planted_pairs():
    """Pairs just above the threshold must meet in a band: at least 0.9 of them, as banding promises far more."""
    rng = np.random.default_rng(7)
    bands, rows = ngram_join.bands_for(0.8, 0.9999)
    seen = met = 0
    while seen < 400:
        words = [f"w{k}" for k in rng.integers(0, 20_000, int(rng.integers(60, 400)))]
        other = list(words)
        for k in rng.integers(0, len(words), max(1, len(words) // 60)):
            other[k] = "changed"
        a, b = (ngram_join.shingles(" ".join(w).encode()) for w in (words, other))
        common = len(np.intersect1d(a, b))
        if 0.8 <= common / (len(a) + len(b) - common) < 0.85:
            seen += 1
            met += bool((ngram_join.band_hashes(a, bands, rows) == ngram_join.band_hashes(b, bands, rows)).any())
    assert met >= 0.99 * seen, (met, seen)


def test_band_count_reaches_the_recall():
    bands, rows = ngram_join.bands_for(0.8, 0.9999)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.9999


# ------------------------------------------------------------------------ suffix index

def brute_repeats(texts, length):
    held = Counter(b[p:p + length] for b in texts for p in range(len(b) - length + 1))
    out = []
    for b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if held[b[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("group", [1, 4096])
def test_suffix_removal_against_brute_force(table, group):
    rng = np.random.default_rng(2)

    def text(n):
        return "".join(rng.choice(list("abé "), n))
    passage, other = text(150), text(90)
    docs = list(EDGE_DOCS) + [(100, text(200) + passage + text(80)), (101, text(33) + passage + text(7)),
                              (102, passage[20:120] + text(40)), (103, text(30) + other + text(50) + other),
                              (104, "ab" * 300), (105, text(500)), (106, passage[:59]), (107, other[:61] + passage[3:70])]
    got = suffix_index.remove_repeats(table(docs, DOCS), length=60, context=24, group=group).collect()
    expected = brute_repeats([(t or "").encode() for _, t in docs], 60)
    same([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got],
         [(i, *e) for (i, _), e in zip(docs, expected)])
    assert suffix_index.remove_repeats(table([], DOCS)).count() == 0


def test_levels_merge_geometrically(spark):
    index = suffix_index.SuffixIndexes(spark)
    found = [index.add(spark.createDataFrame([(1,), (10 + k,), (20,)] + [(20,)] * (k == 0), "suffix long"))
             for k in range(5)]
    assert [len(level) for level in index.levels] == [1, 0, 1]
    assert [sorted({r.suffix for r in f.collect()}) for f in found] == [[20]] + [[1, 20]] * 4


def test_slices_do_not_change_the_anchors(monkeypatch):
    text = np.frombuffer(LONG.encode()[:20_000], np.uint8)
    whole = suffix_index.anchors(text, 400, 160)
    monkeypatch.setattr(suffix_index, "SLICE", 999)
    cut = suffix_index.anchors(text, 400, 160)

    def owner(runs):
        return {p: a for a, lo, hi in zip(*runs) for p in range(lo, hi + 1)}
    assert owner(whole) == owner(cut) and len(owner(cut)) == 20_000 - 399
