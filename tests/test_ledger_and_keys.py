"""Feeds with bad rows, and keys of earlier runs, on files."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from granary.sources import csv, key_index, ledger
from granary.sources.contracts import contract
from granary.sources.csv import Format, SourceError
from granary.sources.key_index import KeyIndex

SPEC = contract("Dim_Warehouse")
HEAD = ",".join(SPEC.columns)
GOOD = 'WH{:02d},"House, ""big""",Pune,MH,West,1000'


def test_the_ledger_names_lines_and_reasons(spark, tmp_path):
    path = tmp_path / "w.csv"
    lines = [HEAD, GOOD.format(1), "", "WH02,House,Pune", GOOD.format(3), "WH04,House,Pune,MH,West,1.5", "W5,  ,Pune,MH,Nowhere,0", "WH06,House,Pune,MH,West,0", GOOD.format(7), " \t", "WH08,a,b,c,West,5,more"]
    path.write_text("\n".join(lines) + "\n")
    good, bad = ledger.split(spark, str(path), SPEC)
    assert sorted(tuple(r) for r in good.collect()) == [(f"WH{k:02d}", 'House, "big"', "Pune", "MH", "West", 1000) for k in (1, 3, 7)]
    assert good.schema["Capacity_Units"].dataType.simpleString() == "bigint"
    found = {r.line: (r.reasons, r.text) for r in bad.collect()}
    assert {k: v[0] for k, v in found.items()} == {
        4: ["width"], 6: ["cast.Capacity_Units"], 7: ["missing.Warehouse_Name"], 8: ["Capacity_Units.minimum"], 11: ["width"],
    }
    assert all(v[1] == lines[k - 1] for k, v in found.items()) and {Path(r.file).name for r in bad.collect()} == {"w.csv"}
    path.write_text(HEAD + "\n")
    assert [d.count() for d in ledger.split(spark, str(path), SPEC)] == [0, 0]


def test_lines_are_numbered_over_parts_and_files(spark, tmp_path):
    for name, n in (("a.csv", 30_000), ("b.csv", 7), ("c.csv", 0)):
        (tmp_path / name).write_text("".join(f"{name} {k + 1}{'x' * (k % 50)}\n" for k in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        rows = ledger.numbered(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() > 5
        wrong = rows.where(F.regexp_extract("value", r"^\S+ (\d+)", 1).cast("long") != F.col("line"))
        assert wrong.count() == 0 and rows.count() == 30_007
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_feeds_that_a_ledger_refuses(spark, tmp_path):
    path = tmp_path / "w.csv"
    path.write_text(f'{HEAD}\nWH01,"Two\nlines",Pune,MH,West,1000\n')
    with pytest.raises(SourceError, match="rows of one line"):
        ledger.split(spark, str(path), SPEC)
    path.write_bytes(f"{HEAD}\n".encode("utf-16"))
    with pytest.raises(SourceError, match="UTF-8"):
        ledger.split(spark, str(path), SPEC, Format(encoding="UTF-16"))
    path.write_text("A,B\n")
    with pytest.raises(SourceError, match="header"):
        ledger.split(spark, str(path), SPEC)
    assert csv.lines(spark, str(path)).rows == 0


SIZES = {"buckets": 16, "bits": 1 << 12, "hashes": 4}


def test_an_increment_drops_what_earlier_runs_had(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "keys"), ["a", "b"], **SIZES)
    r = random.Random(1)
    row = lambda: (r.choice([None, *range(40)]), r.choice([None, "x", "y"]), r.random())
    kept, seen = 0, set()
    for run in range(4):
        rows = [row() for _ in range(30)] * 2
        df = spark.createDataFrame(rows, "a int, b string, v double")
        new, opened = index.unseen(df)
        want = [x for x in rows if x[:2] not in seen]
        assert sorted(map(str, map(tuple, new.collect()))) == sorted(map(str, want)) and len(opened) <= 16
        index.add(df, f"r{run}")
        seen |= {x[:2] for x in rows}
        kept += len(want)
    assert kept < 240 and index.keys.read().count() >= len(seen)


def test_only_buckets_that_may_hold_a_key_are_opened(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "keys"), ["k"], **SIZES)
    assert index.unseen(spark.range(3).withColumnRenamed("id", "k"))[1] == []
    index.add(spark.range(200).withColumnRenamed("id", "k"), "r1")
    known, opened = index.unseen(spark.createDataFrame([(5,), (6,), (7,)], "k long"))
    buckets = {r[0] for r in spark.createDataFrame([(5,), (6,), (7,)], "k long").select(key_index.bucket_of(["k"], 16)).collect()}
    assert known.count() == 0 and set(opened) == buckets
    strangers = spark.range(10_000, 10_300).withColumnRenamed("id", "k")
    unseen, opened = index.unseen(strangers)
    assert unseen.count() == 300 and len(opened) <= 2  # 12 keys a bucket in 4,096 bits: next to no false alarm


def test_a_run_that_fails_between_filters_and_keys(spark, tmp_path, monkeypatch):
    index = KeyIndex(spark, str(tmp_path / "keys"), ["k"], **SIZES)
    df = spark.range(5).withColumnRenamed("id", "k")
    plain = index.keys.commit
    with monkeypatch.context() as m:
        m.setattr(index.keys, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            index.add(df, "r1")
    assert index.unseen(df)[0].count() == 5
    index.keys.commit = plain
    index.add(df, "r1")
    assert index.unseen(df)[0].count() == 0
