"""Files cut into byte ranges anywhere give the rows of the whole-file readers."""

import json
import random
from contextlib import contextmanager

import pytest

from voxscope.sources import csv_safe, json_records, splits


@contextmanager
def small_splits(spark, size):
    keys = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def nasty(rng):
    return "".join(rng.choice(['"', "}", "{", "[", "]", "\\", ",", "\n", "é", "漢", "a", "b ", "\\\""]) for _ in range(rng.randrange(25)))


@pytest.mark.parametrize("size", [97, 1 << 20])
def test_json_arrays_cut_anywhere(spark, tmp_path, size):
    rng = random.Random(size)
    good = [{"id": i, "c": nasty(rng), "d": {"e": [{"f": nasty(rng)}, {}]}} for i in range(60)]
    (tmp_path / "one.json").write_text(json.dumps(good[:30], ensure_ascii=False), encoding="utf-8")
    (tmp_path / "two.json").write_text("\n" + json.dumps(good[30:], indent=2) + "\n", encoding="utf-8")
    (tmp_path / "none.json").write_text(" [ ] ")
    with small_splits(spark, size):
        records, quarantine = json_records.read_json_arrays(spark, str(tmp_path), "id bigint, c string")
        assert sorted((r.id, r.c) for r in records.collect()) == [(g["id"], g["c"]) for g in good]
        assert quarantine.collect() == []


def test_one_bad_value_costs_one_record(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id":1},{"id":"x"},{"id":3},{"id":"y"}]')
    (tmp_path / "b.json").write_text('[1, {"id":5}, {"id": 6} ]')
    records, quarantine = json_records.read_json_arrays(spark, str(tmp_path), "id long")
    assert sorted(r.id for r in records.collect()) == [1, 3, 6]
    assert sorted((r.file[-6:], r.payload) for r in quarantine.collect()) == [
        ("a.json", '{"id":"x"}'), ("a.json", '{"id":"y"}'), ("b.json", '1, {"id":5}')]


def test_broken_files_give_no_records(spark, tmp_path):
    texts = ['[{"id":1}', '[{"id":1},', '[{"id":1}]]', '{"id":1}', '[{"id":1', '[{"id":"1]', "]", '[{"id":1}] x', "nonsense", "[{]}"]
    for k, text in enumerate(texts):
        (tmp_path / f"broken{k}.json").write_text(text)
    (tmp_path / "good.json").write_text('[{"id":2}]')
    records, quarantine = json_records.read_json_arrays(spark, str(tmp_path), "id long")
    assert [r.id for r in records.collect()] == [2]
    assert sorted((r.file[-12:], r.payload) for r in quarantine.collect()) == [(f"broken{k}.json"[-12:], None) for k in range(len(texts))]


@pytest.mark.parametrize("size", [61, 1 << 20])
def test_csv_cut_anywhere(spark, tmp_path, size):
    rng = random.Random(size)
    rows = [(str(i), nasty(rng).replace("\\", "/") or "x", rng.choice([" padded ", "p"])) for i in range(40)]
    df = spark.createDataFrame(rows, "id string, c string, d string").repartition(2)
    df.write.options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(str(tmp_path / "c"))
    whole = sorted(map(tuple, csv_safe.read_csv_safe(spark, str(tmp_path / "c")).collect()))
    with small_splits(spark, size):
        got = csv_safe.read_csv_split(spark, str(tmp_path / "c"))
        assert sorted(tuple(r)[:3] for r in got.collect()) == whole == sorted(rows)
        assert got.where("_corrupt_record IS NOT NULL").count() == 0


def test_a_large_file_is_many_tasks(spark, tmp_path):
    (tmp_path / "c.csv").write_text("a,b\n" + "".join(f'{i},"x\ny""{i}"\n' for i in range(4000)))
    with small_splits(spark, 4000):
        assert splits.pieces(spark, str(tmp_path / "c.csv"), "\n").rdd.getNumPartitions() > 8
        assert csv_safe.read_csv_safe(spark, str(tmp_path / "c.csv")).rdd.getNumPartitions() == 1
        got = csv_safe.read_csv_split(spark, str(tmp_path / "c.csv"))
        assert sorted((int(r.a), r.b) for r in got.collect()) == [(i, f'x\ny"{i}') for i in range(4000)]


def test_surplus_and_missing_fields_are_kept(spark, tmp_path):
    (tmp_path / "c.csv").write_text('a,b\r\n1,2\r\n\r\n1,2,3\r\n4\r\n"5","6\n7"')
    got = csv_safe.read_csv_split(spark, str(tmp_path / "c.csv"))
    assert {(r.a, r.b, r._corrupt_record) for r in got.collect()} == {
        ("1", "2", None), ("1", "2", "1,2,3"), ("4", None, "4"), ("5", "6\n7", None)}
    assert csv_safe.read_csv_split(spark, str(tmp_path / "missing")) is None
