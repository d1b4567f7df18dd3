from voxscope.llm.kneser_ney import count_trusted, trusted_ids


def test_every_trusted_row_trains(spark):
    """More of them than were taken once: all good rows train or calibrate, and each text is counted."""
    n = 30_000
    labels = spark.range(n).selectExpr("id AS doc_id", "1 AS quality", "CAST(id % 10 = 3 AS int) AS toxic")
    training, calibration = trusted_ids(labels)
    train, rest = ({r.doc_id for r in df.collect()} for df in (training, calibration))
    assert len(train) > 20_000 and not train & rest and train | rest == {i for i in range(n) if i % 10 != 3}
    docs = spark.range(n).selectExpr("id AS doc_id", "'abcd' AS text")
    assert {r.gram: r.c for r in count_trusted(docs, training).collect()}[int.from_bytes(b"abcd", "big")] == len(train)


def test_repeated_and_nameless_rows(spark):
    docs = spark.createDataFrame([(1, "abcd"), (1, "abcd"), (None, "abcd"), (2, None), (3, "abcd")], "doc_id long, text string")
    ids = spark.createDataFrame([(1,), (2,), (None,)], "doc_id long")
    assert {r.gram: r.c for r in count_trusted(docs, ids).collect()}[int.from_bytes(b"abcd", "big")] == 2


def test_texts_stay_where_they_lie_while_ids_are_few(spark, tmp_path, monkeypatch):
    """Whatever size Spark guesses; and more ids than that give the same counts."""
    spark.range(1000).selectExpr("id AS doc_id", "repeat('abcd', 100) AS text").write.parquet(f"{tmp_path}/docs")
    ids = spark.range(2_000_000).selectExpr("id % 500 AS doc_id").distinct()
    docs, plan = spark.read.parquet(f"{tmp_path}/docs"), lambda df: df._jdf.queryExecution().executedPlan().toString()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = count_trusted(docs, ids)
        assert "BroadcastHashJoin" in plan(few) and "SortMergeJoin" not in plan(few)
        monkeypatch.setattr("voxscope.llm.kneser_ney.FEW_IDS", 10)
        many = count_trusted(docs, ids)
        assert "SortMergeJoin" in plan(many) and sorted(few.collect()) == sorted(many.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
