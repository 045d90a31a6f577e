import math

import duckdb

import __spark_entry__ as E
from conftest import SF0001

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "log10_conc_mean" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 80


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return str(v)[:10]
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr)


def test_oracle_subset_sf0001(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    qs, sq = E.queries(), E.oracle_sql()
    for name in ("ag_weekly_state", "clean_labels", "mt_report_table", "ag_tail_to_other",
                 "ed_unrepresented_by_state", "fl_dedupe_first"):
        df = qs[name](spark, SF0001)
        res = con.execute(sq[name])
        dcols = [d[0] for d in res.description]
        assert sorted(df.columns) == sorted(dcols), name
        assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, res.fetchall()), name
