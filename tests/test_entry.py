import __spark_entry__ as E


def test_contract_keys_match():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 30


def test_entry_runs(spark):
    df = E.entry(spark)
    assert "Adj_Start_Date" in df.columns
    assert df.count() > 0


def test_every_query_builds_on_smoke_data(spark):
    for name, fn in E.queries().items():
        df = fn(spark, "/root/testdata/sf0.001")
        assert df.columns, name
        df.limit(1).collect()


def test_every_oracle_binds_in_duckdb():
    import duckdb
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages "
              "benchmark labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    for name, sql in E.oracle_sql().items():
        cols = con.execute(f"DESCRIBE {sql}").fetchall()
        assert cols, name
