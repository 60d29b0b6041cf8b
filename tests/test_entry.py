import duckdb

import __spark_entry__ as E

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "orders_outcome_var" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 50


def test_every_oracle_agrees_on_small_fixture(spark, sf):
    """The driver's gate in miniature: rows, column names and an
    order-insensitive value hash for every query that has an oracle."""
    from tools.check_oracle import digest, type_mismatches
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = []
    for name, sql in E.oracle_sql().items():
        s = E.queries()[name](spark, sf)
        cols, rows = s.columns, [tuple(r) for r in s.collect()]
        rel = con.sql(sql)
        dcols, dtypes, drows = rel.columns, rel.types, rel.fetchall()
        if sorted(cols) != sorted(dcols) or len(rows) != len(drows) or \
                digest(cols, rows)[0] != digest(dcols, drows)[0] or type_mismatches(s.schema, dcols, dtypes):
            bad.append(name)
    assert not bad, bad
