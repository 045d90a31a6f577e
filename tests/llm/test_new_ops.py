import hashlib
import html
import random
import re
import time
import zlib

import numpy as np
import pytest
from llm_cases import EDGE_DOCS, LONG, SF0001, SF001, clashing, table  # noqa: F401
from pyspark.sql import functions as F

from surgeflow.llm import html_consensus, periodic, queries, whitening
from surgeflow.llm.common import read_table
from surgeflow.llm.html_blocks import parse

# ------------------------------------------------------------------------ periodic runs


def brute_runs(words, min_length=24):
    best = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(min_length, 3 * q):
                best.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def brute_planted(i, text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    if i is None:
        return words
    h = zlib.crc32(str(i).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
    return words


def brute_op12(i, text):
    words = brute_planted(i, text)
    runs = brute_runs(words)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    milli = None if best is None else 1000 * best[1] // best[2]
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (i, len(runs), *(best or (None, None, None)), milli, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in gone).encode()).hexdigest())


PERIODS = (1, 2, 5, 9, 15, 16, 17, 18, 20, 21, 22, 28, 29, 37, 38, 50, 64, 100, 133)


def periodic_words(rng):
    letters, out = rng.choice([2, 3, 20, 1000]), []
    for _ in range(rng.randint(1, 5)):
        period = rng.choice(PERIODS)
        base = [rng.randrange(letters) for _ in range(period)]
        if period > 6 and rng.random() < 0.3:  # a repeat inside the period
            base = (base[:max(1, period // 5)] * 10)[:period - 1] + [rng.randrange(letters)]
        out += [base[i % period] for i in range(rng.choice([0, period, 3 * period - 1, 3 * period, 5 * period + 7]))]
        out += [rng.randrange(letters) for _ in range(rng.randint(0, 40))]
    return [str(w).encode() for w in out]


@pytest.mark.parametrize("seed", range(6))
def test_runs_against_all_periods(seed):
    rng = random.Random(seed)
    texts = [periodic_words(rng) for _ in range(60)] + [[]]
    assert periodic.runs_of(texts) == [brute_runs(t) for t in texts]
    assert periodic.runs_of(texts, lags=1) == [brute_runs(t) for t in texts]  # all longer periods by scales


def test_nested_runs_and_long_periods():
    inner = [b"a", b"b"] * 15
    texts = [(inner + [b"c"]) * 4, [b"%d" % (i % 4001) for i in range(4001 * 3)], [b"%d" % (i % 4001) for i in range(12_002)],
             [b"x"] * 100_000]
    assert periodic.runs_of(texts) == [brute_runs(texts[0]), [(0, 12_003, 4001)], [], [(0, 100_000, 1)]]


def test_op12_edges(table, spark, tmp_path):
    rows = EDGE_DOCS + [(i, "same " * i + "other\x0bword\x1cjoined") for i in range(40, 90)] + [(41, "same " * 41)] * 2
    rows += [(-5, LONG[:3000] + " " + "to be or not " * 30), (17, "é ü " * 20)]
    table(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_periodic_runs(spark, str(tmp_path))
    assert sorted((tuple(r)[:8] for r in got.collect()), key=repr) == sorted((brute_op12(*r) for r in rows), key=repr)
    empty = periodic.periodic_runs(periodic.with_planted_period(table([], "doc_id long, text string")))
    assert empty.count() == 0


def test_op12_on_documents(spark):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF0001, "documents").collect()]
    got = [tuple(r)[:8] for r in queries.op12_periodic_runs(spark, SF0001).collect()]
    expected = [brute_op12(*r) for r in rows]
    assert sorted(got) == sorted(expected)
    assert sum(r[1] > 0 for r in expected) > 5


# -------------------------------------------------------------------------- whitening


def brute_whitened(vectors):
    """Ids, deviations, rows x components of whitened values and shares by a dense eigensolver."""
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v in vectors], dtype=object)
    n, total = len(x), x.sum(axis=0)
    deviation = [int(((n * row - total) ** 2).sum()) for row in x]
    centred = np.array([[float(n * a - s) / n for a, s in zip(row, total)] for row in x])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1][:32], u[:, ::-1][:, :32]
    return [i for i, _ in vectors], deviation, centred @ u / np.sqrt(e), e / (np.sum(deviation) / n ** 3)


def check_whitened(rows, vectors):
    ids, deviation, expected, share = brute_whitened(vectors)
    k = expected.shape[1]
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert len(rows) == k * len(vectors) and set(got) == set(ids)
    actual = np.array([[got[i][c].whitened for c in range(1, k + 1)] for i in ids])
    signs = np.sign((actual * expected).sum(axis=0))
    assert np.abs(actual * signs - expected).max() < 1e-6
    first = [got[i][1] for i in ids]
    assert [r.deviation for r in first] == deviation and {r.n for r in rows} == {len(vectors)}
    assert np.abs(np.array([got[ids[0]][c].explained for c in range(1, k + 1)]) / share - 1).max() < 1e-9
    moment = actual.T @ actual / len(vectors)
    assert first[0].identity_error < 1e-9 and np.abs(moment - np.eye(k)).max() < 1e-9


def test_op13_against_dense_eigensolver(spark):
    for folder in (SF0001, SF001):
        vectors = [(r.vec_id, r.embedding) for r in read_table(spark, folder, "embeddings").collect()]
        check_whitened(queries.op13_embedding_whitening(spark, folder).collect(), vectors)


def test_filter_reaches_clustered_spectrum(table):
    """More dimensions than the block, eigenvalues close together at the wanted end."""
    rng = np.random.default_rng(3)
    values = np.concatenate((np.linspace(3, 2, 40), np.linspace(1.9, 0.1, 40)))
    vectors = [(i, v.tolist()) for i, v in enumerate(40 * rng.standard_normal((400, 80)) * np.sqrt(values))]
    docs = table(vectors, "vec_id long, embedding array<float>")
    model = whitening.fit(whitening.integer_vectors(docs))
    assert model.cycles > 1 and model.residual < 1e-11
    vectors = [(r.vec_id, r.embedding) for r in docs.collect()]
    check_whitened(whitening.whitened_components(docs).collect(), vectors)


def test_whitening_edges(table):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 2.0, 3.0]), (2, [2.0, 0.5, -1.0]), (2, [2.0, 0.5, -1.0]), (None, [0.0, 9.0, 4.0]), (5, [7.0, -3.0, 2.5])]
    bad = [(6, None), (7, [1.0, None, 2.0]), (8, [nan, 1.0, 2.0]), (9, [1.0, inf, 2.0]), (10, [1.0, -inf, 2.0]), (11, []),
           (12, [1.0, 2.0])]
    schema = "vec_id long, embedding array<double>"
    rows = whitening.whitened_components(table(good + bad, schema)).collect()
    assert len(rows) == 15 and {r.n for r in rows} == {5}
    _, deviation, _, _ = brute_whitened(good)
    assert sorted(r.deviation for r in rows if r.component == 2) == sorted(deviation)
    assert rows[0].identity_error < 1e-9
    for same in ([], bad[:5], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3):
        none = whitening.whitened_components(table(same, schema))
        assert none.count() == 0 and none.columns[:3] == ["vec_id", "component", "n"]
    # one direction only, and entries whose deviation leaves a long
    line = whitening.whitened_components(table([(i, [float(i), 2.0 * i]) for i in range(9)], schema)).collect()
    assert {r.component for r in line} == {1} and len(line) == 9
    far = whitening.whitened_components(table([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 5.0])], schema)).collect()
    assert {r.deviation for r in far if r.vec_id < 3} == {None}


# ------------------------------------------------------------------------- main text


def article_of(markup):
    """The generated pages' article by plain patterns."""
    body = re.search("<article>(.*)</article>", markup, re.S)[1]
    parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", p)).split()) for p in re.split("</?(?:p|h1)>", body)]
    return "\n".join(p for p in parts if p)


def test_op11_on_pages(spark):
    pages = {r.page_id: r for r in read_table(spark, SF001, "pages").collect()}
    got = queries.op11_html_consensus(spark, SF001).collect()
    assert {r.page_id: r.text for r in got} == {i: article_of(p.html) for i, p in pages.items()}
    assert all(r.n_chars == len(r.text) and r.url == pages[r.page_id].url for r in got) and len(got) == len(pages)


STORY = "<p>A long first paragraph, with a clause or two in it.</p><p>And a second &amp; last\n one <b>of</b> some length.</p>"
TEXT = "A long first paragraph, with a clause or two in it.\nAnd a second & last one of some length."


def test_blocks_and_clutter():
    page = f"""<html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar">
    <header><h1>Site</h1></header><div id="cookie-notice"><p>We use cookies</p></div><nav><a href=x>Menu</a></nav>
    <main><article class="post post-17"><header><h1>Head&shy;line</h1><p>by someone</p></header>{STORY}
    <form><p>Sign up <input name=q></p></form><script>var a = "</p>";</script><!-- <p>no</p> --><ul><li>one<li>two</ul>
    <table><tr><td>a<td title="hidden > gem">b</table>x<br>y &lt;3 &#x41;&am<div class="advert">Buy</div>
    <div style="display: none">secret</div><p hidden>gone</p><section class="comments"><p>First!</p></section></article></main>
    <aside>Related</aside><div class=sidebar>More</div><footer>&copy; us</footer></body></html>"""
    parsed = parse(page)
    keys = html_consensus.path_keys(parsed)
    article = keys[parsed.label.index("article.post.post-#")]
    text, _ = html_consensus.extracted(parsed, [article])
    assert text == f"Head\xadline\n{TEXT}\none\ntwo\na\nb\nx y <3 A&am"


def test_consensus_over_hosts(table):
    def page(story, aside, extra=""):
        return (f"<body><div class='lead n{len(story)}'><div class='c1'>{story}</div></div><div class='box'><p>{aside}</p></div>"
                f"{extra}</body>")
    rows = [(i, f"https://a.example/{i}", page(STORY * 3, "short words")) for i in range(6)]
    # the box is longer than the story here; the host's other pages decide
    rows += [(10, "HTTP://user@A.example:80/x", page(STORY, "a box of words that is far longer than the story. " * 20))]
    rows += [(11, "https://a.example/other", f"<body><article>{STORY}</article><div class=box><p>short</p></div></body>")]
    rows += [(12, "https://a.example/other2", f"<body><article>{STORY}</article></body>")]
    rows += [(13, "https://b.example/", page(STORY, "tiny")), (14, None, f"<body><div>{STORY}</div></body>"),
             (15, "no url", ""), (16, "https://b.example/", None), (None, "https://c.example", "plain &lt; text\n only"),
             (17, "https://a.example/9", "<body><div class='lead n9'><div class='c2'></div></div></body>")]
    got = {r.page_id: r for r in html_consensus.main_text(table(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows)
    assert [got[i].text for i in range(6)] == ["\n".join([TEXT] * 3)] * 6
    assert got[10].text == TEXT and got[10].by_host and got[11].text == TEXT and got[12].text == TEXT
    assert got[13].text == TEXT and got[14].text == TEXT
    assert got[15].text == "" and got[16].text == "" and got[None].text == "plain < text only" and got[17].text == ""
    assert html_consensus.main_text(table([], "page_id long, url string, html string")).count() == 0


HOSTILE = ["<div>", "<!--", '<a b="', "<title>", "<script>", "<", "<p><b>", "<ul><li>", "</p>", "<head ", "&", "<a x= ' ", "<td>"]


@pytest.mark.parametrize("part", HOSTILE)
def test_scan_is_linear(part):
    took = []
    for n in (100_000, 300_000):
        begin = time.perf_counter()
        page = parse(part * n)
        html_consensus.extracted(page, [])
        took.append(time.perf_counter() - begin)
    assert took[1] < 8 * took[0] + 1  # a quadratic scan takes hours


def test_end_tags_without_start_cost_nothing():
    begin = time.perf_counter()
    parse("<div>" * 100_000 + "</span></p></td>" * 100_000 + "<b>" * 100_000 + "</i>" * 100_000)
    assert time.perf_counter() - begin < 30


def test_clashing_columns(spark):
    pages = clashing(read_table(spark, SF0001, "pages")).withColumn("host", F.lit(1)).withColumn("paths", F.lit("x"))
    assert html_consensus.main_text(pages).count() == pages.count()
