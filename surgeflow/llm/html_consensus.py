"""Main text of web pages by a vote of each host's pages on their container paths.

1. Each page is scanned once (``html_blocks``) and its containers are scored: a block gives its
   text, less the link text, to the container that holds it and half as much to the one around
   that; blocks that are mostly links give nothing.  A container's path is the chain of its
   ancestors' tags and classes, numbers in them made equal.  A page casts a vote of 0 to 1,000
   for every path it has: its score over the best of the page.
2. Votes are summed per host and path.  The value of a path is its mean vote over the pages
   that have it (one more page counted in, so support matters); paths on one page only of a
   host with several, or of a value below ``LEAST``, do not stand.
3. Every page is scanned again and gives the blocks of the containers on the path of greatest
   value that it has; where it has none of them, of its own best container.

Menus, headers, footers, sidebars, notices, adverts, forms, reader comments, hidden parts,
scripts and styles are left out inside a container as well.

Votes are whole numbers, so the sums do not depend on their order.  The votes of a host are
grouped per path with partial sums, so a host with a third of all pages is no single group;
the winners are written, so the join that brings them to the pages broadcasts them only where
their files are below Spark's own limit, and else is a sort-merge join split by AQE.

Edge cases: a null or empty page and one without text give an empty text; a null url, or one
without a host, belongs to the host ''; markup that never closes ends with the page; repeated
rows vote each and are extracted each; ids may be null; pages without any container are one
container; a page of any length is scanned whole, in linear time; extra columns are not read;
an empty table gives an empty result.
"""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage
from .html_blocks import Page, parse

#: Least mean vote (of 1,000) of a path that stands, and the share of links from which a block counts nothing.
LEAST, MOSTLY_LINKS = 300, 0.5


def host_of(url: Column) -> Column:
    """Lower-case host of a url, without user and port; '' if it has none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(found)


def path_keys(page: Page) -> list[int]:
    """A 64-bit key of every container's path: equal chains of labels have equal keys."""
    keys = [0]
    for parent, label in zip(page.parent[1:], page.label[1:]):
        value = xxhash.xxh3_64_intdigest(label.encode("utf-8", "surrogatepass"), seed=keys[parent])
        keys.append(value)
    return keys


def scores(page: Page) -> list[float]:
    """Score of every container: text of its own blocks, and half of that of its children."""
    out = [0.0] * len(page.parent)
    for text, owner, linked in zip(page.texts, page.owner, page.linked):
        if linked < MOSTLY_LINKS * len(text):
            out[owner] += len(text) - linked
            if owner:
                out[page.parent[owner]] += (len(text) - linked) / 2
    return out


def signed(key: int) -> int:
    return key - (1 << 64) if key >> 63 else key


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, tail, vote): one row per page and path; ``tail`` names the last two labels."""
    names = ["host", "path", "tail", "vote"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, rows = batch.column(0).to_pylist(), []
            for host, markup in zip(hosts, batch.column(1).to_pylist()):
                page = parse(markup or "")
                score, most = scores(page), 0.0
                best: dict[int, tuple[float, int]] = {}
                for at, key in enumerate(path_keys(page)):
                    total = best.get(key, (0.0, at))[0] + score[at]
                    best[key] = total, at
                    most = max(most, total)
                for key, (total, at) in best.items() if most else ():
                    tail = ">".join(page.label[k] for k in (page.parent[at], at) if k > 0)
                    rows.append((host, signed(key), tail, int(1000 * total / most)))
            columns = zip(*rows) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.int64()))], names)

    return pages.select("host", "html").mapInArrow(run, "host string, path long, tail string, vote long")


def consensus(cast: DataFrame, least: int = LEAST) -> DataFrame:
    """(host, paths): the standing paths of every host, of greatest value first."""
    # written, as it is read twice and the pages should be scanned once
    per_path = stage(cast.groupBy("host", "path").agg(F.sum("vote").alias("votes"), F.count(F.lit(1)).alias("pages"),
                                                      F.min("tail").alias("tail")), "host-votes")
    value = F.col("votes") / (F.col("pages") + 1)
    # the root path is on every page with text, so its pages are the host's
    host_pages = per_path.where("path = 0").select("host", F.col("pages").alias("host_pages"))
    standing = per_path.join(host_pages, "host").where(
        (F.col("votes") >= least * F.col("pages")) & ((F.col("pages") > 1) | (F.col("host_pages") == 1)))
    ranked = F.sort_array(F.collect_list(F.struct((-value).alias("order"), "path", "tail")))
    return standing.groupBy("host").agg(F.transform(ranked, lambda p: F.struct(p["path"], p["tail"])).alias("paths"))


def extracted(page: Page, paths: list[int]) -> tuple[str, bool]:
    """(text, whether a path of the host was used): blocks in page order, one per line."""
    keys = path_keys(page)
    have = set(keys)
    wanted = next((p for p in paths if p in have), None)
    if wanted is None:
        score = scores(page)
        best = max(range(len(score)), key=score.__getitem__)
        inside = [k == best for k in range(len(keys))]
    else:
        inside = [k == wanted for k in keys]
    for k in range(1, len(keys)):  # parents come before their children
        inside[k] = inside[k] or inside[page.parent[k]]
    return "\n".join(t for t, owner in zip(page.texts, page.owner) if inside[owner]), wanted is not None


def main_text(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``text``, ``n_chars`` and ``by_host`` (whether a path
    that its host's pages agreed on was used)."""
    pages = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    winners = stage(consensus(votes(pages), least), "host-paths")
    schema = T.StructType([pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType()), T.StructField("by_host", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [extracted(parse(markup or ""), [p % (1 << 64) for p in paths or ()])
                     for markup, paths in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            texts = [t for t, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64()), pa.array([b for _, b in found], pa.bool_())],
                [f.name for f in schema])

    known = pages.join(winners.select("host", F.col("paths.path").alias("paths")), "host", "left")
    return known.select("page_id", "url", "html", "paths").mapInArrow(run, schema)
