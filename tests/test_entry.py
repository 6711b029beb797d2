import __spark_entry__ as entry


def test_names():
    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q) and "filter_summary" in q


def test_entry(spark):
    got = entry.entry(spark)
    assert got.columns == ["outcome", "docs", "bytes", "est_tokens"] and sum(r.docs for r in got.collect()) == 200


def test_against_sql(spark):
    """A few queries side by side with their SQL; the driver compares them all."""
    import duckdb

    sf = "/root/testdata/sf0.001"
    c = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels", "orders"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name in (
        "filter_reasons", "quality_score", "exact_dedup_per_source", "chunk_documents", "qa_pairs", "shard_manifest", "byte_budget",
        "loader_fim", "pack_rows", "pack_segments", "interleaved_mix", "hamming_band_join", "simhash_best", "simhash_greedy",
        "jsonl_shards", "repaired_lines", "posts_xml", "loader_fim_drawn", "loader_draws"
    ):
        got = entry.queries()[name](spark, sf)
        want = c.sql(entry.oracle_sql()[name])
        order = sorted(got.columns)
        assert order == sorted(want.columns), name
        assert sorted(
            map(str, (tuple(r[k] for k in order) for r in got.collect()))
        ) == sorted(map(str, want.select(*order).fetchall())), name
