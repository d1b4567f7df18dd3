from voxscope.session import stage
from voxscope.sources import splits


def test_records_put_in_order_without_their_texts(spark, tmp_path, monkeypatch):
    """Records over several lines and byte ranges come back whole, and their texts are stored once."""
    records = [f'{i},"line {i}\n""quoted"" {"x" * (i % 50)}\r\nend"' if i % 3 else f"{i},plain" for i in range(400)]
    (tmp_path / "a.csv").write_text("\n".join(["id,text", *records]) + "\n", newline="")
    stored = []
    monkeypatch.setattr(splits, "stage", lambda df, name: stored.append((name, "text" in df.columns)) or stage(df, name))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        found = {r.record: r.text for r in splits.csv_records(spark, f"{tmp_path}/a.csv").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [found[i] for i in range(401)] == ["id,text", *records]
    assert [name for name, has_text in stored if has_text] == ["csv-lines"]
