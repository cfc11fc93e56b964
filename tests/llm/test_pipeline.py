"""The stages one after another on a small table."""

from voxloom.llm import packing, quality, setjoin


def test_stages_hand_on_documents(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.storage.written(stage(spark, docs, sf), name)
        assert docs.columns == columns
        left[name] = docs.count()
    assert left["quality_rules"] == quality.judge(spark.read.parquet(f"{sf}/documents.parquet")).where("kept").count()
    assert left["quality_rules"] >= left["line_dedup"] >= left["near_duplicates"] > 0
    assert setjoin.link(docs).where("doc_id != component_id").count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert last.select("doc_id").distinct().count() == left["near_duplicates"] and packing.MAX_TOKENS == 2048


def test_stages_take_odd_tables(spark):
    """Nulls, empties, repeats, clashing names of columns, and no rows at all."""
    import corpus_pipeline

    names = "doc_id long, text string, lang string, source string, n_chars long, removed string, rid long, key long, id long, text_key string, host string, __key int, __id int, keeper string, n long"
    long = " ".join(f"w{i}" for i in range(80))
    rows = [(1, long), (1, long), (None, long + " x"), (2, None), (3, ""), (3, long + "\n" + " ".join(f"v{i}" for i in range(90))), (4, " ".join(f"u{i}" for i in range(70000)))]
    full = [(i, t, "en", None if i == 3 else "s", 0, "r", 7, 8, 9, "k", "h", 5, 6, "p", 4) for i, t in rows]
    for table in (full, []):
        docs = spark.createDataFrame(table, names)
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, "")
            assert docs.columns == columns
            got = docs.collect()
            assert all(tuple(r)[5:] == full[0][5:] for r in got)
        assert {(r.doc_id, r.text.split(" ")[0]) for r in got} == ({(1, "w0"), (3, "v0"), (4, "u0"), (None, "w0")} if table else set())
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() >= len(got)
