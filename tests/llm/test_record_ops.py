import base64
import gzip
import hashlib
import html
import re
import time
import uuid
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from llm_cases import SF001, clashing, same, table  # noqa: F401
from pyspark.sql import functions as F

from surgeflow.llm import chat, html_blocks, queries, toxicity, warc
from surgeflow.llm.common import read_table, unescape

# -------------------------------------------------------------------------------- WARC

PAGES = [(1, "http://a.example/", "<html lang='en'><head><title>T &amp; U</title><style>p{}</style></head><body><p>One"
                                  "<br>two &lt;3 <!-- no --><script>var x='</p>';</script><b>bold</b></p></body></html>"),
         (2, "http://b.example/\nX: y", None), (3, None, ""), (1, "http://a.example/", "<p>again</p>"),
         (None, "http://c.example/", "plain < text & more &copy; \r\n\r\n  spaced")]
PAGE = "page_id long, url string, html string"


def test_plain_text():
    assert warc.plain_text(PAGES[0][2]) == "One\ntwo <3 bold"
    assert warc.plain_text(PAGES[4][2]) == "plain < text & more © \n spaced".replace(" \n ", "\n")


#: Tokens of a page by one pattern per place, the slow and plain reading of ``plain_text``.
HIDES = r"(?i)<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)"
TOKENS = [(re.compile(p, re.S), out) for p, out in (
    (r"<!--.*?(?:-->|\Z)", " "), (HIDES, " "), (r"(?i)<head\b.*?(?:</head\s*>|(?=<body[\s/>]))", " "),
    (r"(?i)</?(?:br|hr|p|div|li|ul|ol|tr|table|h[1-6]|section|article|header|footer|nav|body|blockquote|pre|td|th|dd|dt|dl|"
     r"form|main|aside|title)\b[^>]*>", "\n"), (r"<[/!?a-zA-Z][^>]*>", ""), (r"<[/!?a-zA-Z][^>]*\Z", ""))]


def slow_text(markup):
    at, out = 0, []
    while at < len(markup):
        for pattern, made in TOKENS:
            found = pattern.match(markup, at)
            if found:
                out.append(made)
                at = found.end()
                break
        else:
            out.append(markup[at])
            at += 1
    return re.sub(r" ?\n[\n ]*", "\n", re.sub(r"[^\S\n]+", " ", html.unescape("".join(out)))).strip()


@pytest.mark.parametrize("seed", range(4))
def test_plain_text_of_random_markup(seed):
    rng = np.random.default_rng(seed)
    parts = ["<p>", "</p>", "<head>", "</head>", "<body class=x>", "<script>", "</script >", "<STYLE>", "</style>", "<!--", "-->",
             "<b", ">", "<br/>", "<", "</", "<3", "&lt;", "&#65;", "word", " ", "\n", "<p_x>", "<title>", "</title>", "é", "<?x?>",
             "<noscript>", "</noscript>", "</head", "<header>", "<template a='>'>"]
    for _ in range(1500):
        markup = "".join(rng.choice(parts, rng.integers(0, 25)))
        assert warc.plain_text(markup) == slow_text(markup), markup


@pytest.mark.parametrize("part", ["<head ", "<head>", "<title>", "<title ", "<html ", "<html lang ", "<!--", "<script>", "<a ", "<", "</", "&#"])
def test_a_million_unclosed_tags(part):
    started = time.process_time()
    page = part * 10**6
    warc.plain_text(page), warc.page_title(page), warc.page_language(page)
    assert time.process_time() - started < 20


def test_references_of_any_length():
    many = "0" * 5000
    assert unescape(f"&#{many}65;&#{'9' * 5000};&#65;&#x{many}41&amp;&#{many}") == "A\ufffdAA&\ufffd"
    assert warc.plain_text(f"<p>a&#{'9' * 10**6};") == "a\ufffd"
    assert html_blocks.parse(f"<p>a&#{'9' * 5000};</p>").texts == ["a\ufffd"]


def test_title_and_language():
    assert warc.page_title("<TITLE x>a &amp; b</title ><title>c</title>") == "a & b"
    assert warc.page_title("<title>never") is None and warc.page_title("<title") is None and warc.page_title("") is None
    assert warc.page_language("<html xml:lang='en' lang=de-AT><html lang=fr>") == "de-AT"
    assert warc.page_language("<html><p lang=en>") is None and warc.page_language("<p>") is None


def test_op1_against_plain_records(spark):
    """Every column of the query, recomputed page by page."""
    space = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

    def sha(data):
        return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()

    expected = {}
    for page in read_table(spark, SF001, "pages").collect():
        body = (page.html or "").encode()
        label = " ".join(["page", str(page.page_id), *([page.url] if page.url is not None else [])])
        source = f"<urn:uuid:{uuid.UUID(hashlib.md5(label.encode()).hexdigest())}>"
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n"
        ids = {k: f"<urn:uuid:{uuid.uuid5(space, source + chr(0) + k)}>" for k in ("metadata", "conversion")}
        title = re.search(r"(?is)<title\b[^>]*>(.*?)</title\s*>", page.html or "")
        language = re.search(r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([\w-]+)", page.html or "")
        text = slow_text(page.html or "")
        about = [*[("source-headers", x) for x in http.split("\r\n") if x], ("source-block-digest", sha(http.encode() + body)),
                 ("source-payload-digest", sha(body)), ("source-payload-length", str(len(body))),
                 ("conversion-record", ids["conversion"])]
        about += [("title", " ".join(html.unescape(title[1]).split()))] if title else []
        about += [("language", language[1])] if language else []
        about += [("text-length", str(len(text)))]
        blocks = {"metadata": ("application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in about)),
                  "conversion": ("text/plain; charset=utf-8", text)}
        for kind, (mime, block) in blocks.items():
            data = block.encode()
            url = " ".join(page.url.split()) if page.url is not None else None
            lines = [("WARC-Type", kind), ("WARC-Record-ID", ids[kind]), ("WARC-Target-URI", url),
                     ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Refers-To", source), ("WARC-Refers-To-Target-URI", url),
                     ("WARC-Refers-To-Date", "1970-01-01T00:00:00Z"), ("X-Source-Payload-Digest", sha(body)),
                     ("Content-Type", mime), ("WARC-Block-Digest", sha(data)), ("Content-Length", str(len(data)))]
            header = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines if v is not None)
            whole = hashlib.sha256((header + "\r\n").encode() + data).hexdigest()
            expected[page.page_id, kind] = (ids[kind], source, sha(data), sha(http.encode() + body), sha(body), len(data), whole,
                                            header, block)
    rows = queries.op1_warc_derivatives(spark, SF001).collect()
    got = {(r.page_id, r.record_type): tuple(r)[2:] for r in rows}
    assert len(rows) == len(expected) and got == expected


def test_derivatives_link_to_their_response(table):
    responses = warc.responses_from_pages(table(PAGES, PAGE))
    rows = warc.derivatives(responses.withColumn("header", F.lit("x")), ("page_id",)).collect()
    assert len(rows) == 2 * len(PAGES)
    by_source = {r.record_id: r for r in responses.collect()}
    for r in rows:
        source = by_source[r.refers_to]
        payload = (source.payload or "").encode() if r.page_id != 1 else None
        data = r.block.encode()
        digest = "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert r.block_digest == digest and r.n_bytes == len(data)
        lines = r.header.split("\r\n")
        assert lines[0] == "WARC/1.1" and f"WARC-Refers-To: {r.refers_to}" in lines
        assert f"Content-Length: {len(data)}" in lines and f"WARC-Block-Digest: {digest}" in lines
        assert all(re.match(r"[\w-]+: ", x) for x in lines[1:-1])  # a line end in a uri adds no field
        if payload is not None:
            expected = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
            assert r.source_payload_digest == expected
    meta = next(r for r in rows if r.record_type == "metadata" and r.page_id == 1)
    assert "source-headers: Content-Type: text/html; charset=utf-8" in meta.block and "title: T & U" in meta.block
    assert len({r.record_id for r in rows if r.page_id == 3}) == 2
    assert warc.derivatives(warc.responses_from_pages(table([], PAGE))).count() == 0


def test_responses_with_missing_fields(table):
    rows = [(None, None, None, None, None), (None, "http://x/", "2024-01-01T00:00:00Z", "HTTP/1.1 200 OK\r\nA: b", "t")]
    made = warc.derivatives(table(rows, ", ".join(f"{c} string" for c in warc.RESPONSE), extra=False)).collect()
    assert len({r.record_id for r in made}) == 4 and all(r.refers_to.startswith("<urn:uuid:") for r in made)


def test_written_files_parse_as_records(table, tmp_path):
    records = warc.derivatives(warc.responses_from_pages(table(PAGES, PAGE)))
    warc.write_warc(records, str(tmp_path / "out"))
    raw = b"".join(gzip.open(p).read() for p in sorted((tmp_path / "out").glob("part-*")))
    found = 0
    while raw:
        head, _, rest = raw.partition(b"\r\n\r\n")
        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
        digest = re.search(rb"WARC-Block-Digest: (\S+)", head)[1].decode()
        assert digest == warc.sha1(rest[:size]) and rest[size:size + 4] == b"\r\n\r\n"
        raw, found = rest[size + 4:], found + 1
    assert found == 2 * len(PAGES)


# -------------------------------------------------------------------------------- chat

TURN = "conv_id long, turn long, role string, text string"


def brute_chat(rows):
    convs = defaultdict(list)
    for c, t, role, text in rows:
        convs[c].append(((t is not None, t), (role is not None, role or ""), (text is not None, text or "")))
    turns = {c: [(r, x) for _, r, x in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, t in turns.items():
        longer = any(len(o) > len(t) and o[:len(t)] == t for o in turns.values())
        equal = [k for k, o in turns.items() if o == t]
        if not longer and c == min(equal, key=lambda k: (k is None, k)):
            out[c] = "".join(f"<|{r[1]}|>\n{x[1]}\n" for r, x in t)
    return out


def test_snapshots_collapse_to_maximal_conversations(spark, table):
    rows = []
    for c in range(6):  # cumulative snapshots of one conversation, the longest twice
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t}") for t in range(min(c, 4) + 1)]
    rows += [(20, 0, "user", "turn 0"), (20, 1, "assistant", "another")]  # shares a first turn only
    rows += [(30, 0, "user", None), (31, 0, "user", ""), (32, 0, None, "x"), (32, 0, None, "x"), (32, None, "a", "b")]
    rows += [(None, 0, "user", "lost"), (40, 0, "user", "long " * 50_000), (41, 7, "user", "turn 0")]
    rows += [(50, t, "user", f"many {t}") for t in range(70)]  # spans ranges and chunks
    got = chat.collapse(table(rows, TURN), chunk_turns=16).collect()
    texts = defaultdict(list)
    for r in sorted(got, key=lambda r: r.chunk):
        texts[r.conv_id].append(r.text)
        assert r.first_turn == r.chunk * 16 + 1
    assert {c: "".join(t) for c, t in texts.items()} == brute_chat(rows)
    assert len(texts[50]) == 5
    assert chat.collapse(table([], TURN)).count() == 0


# ---------------------------------------------------------------------------- toxicity

def auc(score, label):
    rank = score.argsort().argsort() + 1
    n = label.sum()
    return (rank[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


def test_held_out_accuracy(spark):
    docs, labels = read_table(spark, SF001, "documents"), read_table(spark, SF001, "labels")
    scored = toxicity.toxicity_scores(clashing(docs), labels).drop("text")
    assert scored.count() == docs.count()
    found = scored.join(labels, "doc_id").toPandas()
    seen = found[~found.held_out]
    assert auc(seen.score.to_numpy(), seen.toxic.to_numpy()) > 0.99
    unseen = found[found.held_out]
    assert auc(unseen.score.to_numpy(), unseen.toxic.to_numpy()) > 0.8
    assert ((found.score >= 0) & (found.score <= 1)).all()


def test_toxicity_edges(table):
    docs = [(i, "you are an awful fool today" if i % 3 == 0 else "a calm and gentle day at sea") for i in range(90)]
    docs += [(None, "awful fool"), (500, None), (501, ""), (502, "calm " * 50_000), (502, "calm " * 50_000)]
    labels = [(i, int(i % 3 == 0)) for i in range(90)] + [(None, 1), (7, None), (9999, 1), (3, 1)]
    s = toxicity.Settings(word_bits=10, pair_bits=12, shards=2, l1=0.2)
    docs, labels = table(docs, "doc_id long, text string"), table(labels, "doc_id long, toxic int")
    rows = toxicity.toxicity_scores(docs, labels, s).collect()
    assert len(rows) == 95
    score = {r.doc_id: r.score for r in rows}
    assert min(score[i] for i in range(0, 90, 3)) > 0.5 > max(score[i] for i in range(1, 90, 3))
    assert score[500] == score[501] and score[502] < 0.5 < score[None]
    assert all(r.predicted == int(r.score >= 0.5) for r in rows)
    prior = toxicity.toxicity_scores(docs, labels.limit(0), s).select("score").distinct().collect()
    assert len(prior) == 1 and 0 < prior[0].score < 1
    assert toxicity.toxicity_scores(docs.limit(0), labels, s).count() == 0


def plain_training(rows, s):
    """FTRL on the shards' (features, label) lists, all touched coordinates averaged, then filtered."""
    z, n = np.zeros(s.size), np.zeros(s.size)
    for epoch in range(s.epochs):
        total = np.zeros((3, s.size))
        for part in rows.values():
            order = np.random.default_rng(epoch).permutation(len(part))
            part, z1, n1 = sorted(part), z.copy(), n.copy()
            toxicity.ftrl_pass([(toxicity.unpack_features(part[k][0]), part[k][1]) for k in order], z1, n1, s)
            total += (n1 != 0, np.where(n1 != 0, z1, 0), n1)
        z, n = total[1:] / np.maximum(1, total[0])
        gone = np.abs(z) <= s.l1 / 4
        gone[-1] = False
        z[gone] = n[gone] = 0
    return toxicity.weights_of(z, n, s)[:-1]


def test_training_averages_all_touched_coordinates(spark, table):
    s = toxicity.Settings(word_bits=12, pair_bits=14)
    rng = np.random.default_rng(6)
    docs = []
    for i in range(240):
        words = [f"w{k}" for k in rng.integers(0, 60, 12)] + (["awful"] if i % 4 == 0 else [])
        docs.append((i, " ".join(words + [f"rare{rng.integers(0, 40)}"])))
    labels = [(i, int(i % 4 == 0)) for i in range(240)]
    docs.sort(key=lambda d: d[0] % 4 != 0)  # by label
    frame, marks = table(docs, "doc_id long, text string"), table(labels, "doc_id long, toxic int")
    shard = {r.doc_id: r.k for r in frame.select(
        "doc_id", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(s.shards)).alias("k")).collect()}
    rows = {}
    for i, t in docs:
        at = np.unique(toxicity.feature_indices(t.encode(), s))
        features = toxicity.pack_features(at)
        assert (toxicity.unpack_features(features) == at).all()
        rows.setdefault(shard[i], []).append((features, float(i % 4 == 0)))
    expected = plain_training(rows, s)
    for parts in (1, 7):  # the order and files of the table do not matter
        at, w, _ = toxicity.train(frame.repartition(parts), marks, s)
        got = np.zeros(s.size - 1)
        got[at] = w
        assert np.allclose(got, expected * toxicity.values_of(np.arange(s.size - 1), s), atol=1e-4)
    assert (expected != 0).any()


def test_small_opposing_states_count_in_the_mean():
    s = toxicity.Settings(word_bits=4, pair_bits=5)
    packed = [row for z in (-1.8, 0.1, 0.2, 0.3) for row in toxicity.pack_state(
        np.array([3, 7, s.size - 1]), np.array([z, -1.8, 0.0]), np.ones(3))]
    merged = toxicity.merge_states(pd.DataFrame(packed), s)
    assert merged["at"].tolist() == [7, s.size - 1]  # the mean of coordinate 3 is -0.3


def test_training_sample_holds_a_repeated_row_once(table):
    s = toxicity.Settings(word_bits=10, pair_bits=12, max_rows=30)
    docs = [(1, "same text")] * 200 + [(1, "another text"), (2, "same text"), (3, None), (3, None)]
    labels = table([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    sample = toxicity.training_sample(table(docs, "doc_id long, text string"), labels, s)
    assert sorted(r.label for r in sample.collect()) == [0, 0, 1, 1]
    assert toxicity.bounded(sample, s).count() == 4
    many = table([(1, f"text {i}") for i in range(2000)], "doc_id long, text string")
    assert 10 < toxicity.bounded(toxicity.training_sample(many, labels, s), s).count() < 60


def test_l1_keeps_the_model_sparse():
    rng, s = np.random.default_rng(0), toxicity.Settings(word_bits=12, pair_bits=12)
    examples = [(np.unique(np.append(rng.integers(10, 4000, 30), 5 if y else 6)), float(y))
                for y in rng.integers(0, 2, 400)]
    z, n = np.zeros(s.size), np.zeros(s.size)
    for _ in range(3):
        toxicity.ftrl_pass(examples, z, n, s)
    w = toxicity.weights_of(z, n, s)
    assert w[5] > 1 > -1 > w[6] and (w[10:4000] != 0).mean() < 0.2
