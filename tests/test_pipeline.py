"""Small CSV files through ingestion, increments and curation."""

import datetime as dt
import json
from pathlib import Path

import pytest

from granary.functions.scalar import snake
from granary.operators.missing import MissingPolicy, OnMissing
from granary.plans import curate, ingest
from granary.plans.settings import JsonLines, Retry, Settings, env_file, from_env, passing, redacted
from granary.sources import checkpoints, csv, publish
from granary.sources.contracts import CONTRACTS, contract
from granary.sources.csv import SourceError
from granary.streaming import continuous

DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(4)]
ROWS = {
    "Fact_Sales": [f"{d},S001,P00001,10,{k + 1},2,10.0,0.5,Spring,,Sunny,9.0,20.0,50,0,{10.0 * (k + 1)}" for k, d in enumerate(DAYS)],
    "Fact_Inventory": [f"{d},S001,P00001,20,5,{k + 1},0,{20 - k - 1}" for k, d in enumerate(DAYS)],
    "Fact_PurchaseOrders": ["PO0000001,SUP001,S001,P00001,2024-01-01,2024-01-05,3,Pending"],
    "Dim_Product": ['P00001,"Big, ""red"" box",Box,Toys,Sub,Acme,5.0,9.0,1,2,30,SUP001,1.0,2.0'],
    "Dim_Store": ["S001,Main,Pune,MH,West,Large,WH01"],
    "Dim_Date": [f"{d},2024,1,{d.day},{d:%A},1,{d.weekday() >= 5},Winter" for d in DAYS],
    "Dim_Supplier": ["SUP001,Sup,3,10,0.9,Pune,MH,IN,a@b.in,+91-0123456789"],
    "Dim_Warehouse": ["WH01,House,Pune,MH,West,1000"],
    "Weather": [f"{d},Pune,21.0,55,0.5,Rainy" for d in DAYS],
    "Promotion": ["PROMO0001,Spring,2024-01-01,2024-01-02,0.25"],
    "Holiday": ["2024-01-01,New Year"],
}


def put(root: Path, name: str, rows, header=None, bom="") -> None:
    head = header or ",".join(contract(name).columns)
    (root / f"{name}.csv").write_text(bom + "\n".join([head, *rows]) + "\n", encoding="utf-8")


@pytest.fixture
def feed(tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    for name, rows in ROWS.items():
        put(source, name, rows, bom="﻿" if name == "Holiday" else "")
    return source, Settings(
        source_root=str(source), raw_root=str(tmp_path / "raw"), curated_root=str(tmp_path / "curated"), checkpoint_root=str(tmp_path / "marks"), environment="test"
    )


def test_end_to_end(spark, feed):
    source, settings = feed
    run = ingest.ingest(spark, settings)
    assert {t.status for t in run.tables} == {"loaded"} and len(run.tables) == 11
    again = ingest.ingest(spark, settings)
    assert {(t.status, t.reason) for t in again.tables} == {("skipped", "source_unchanged")}
    # one later row, one at the watermark and one dimension update
    later = DAYS[-1] + dt.timedelta(days=1)
    put(source, "Fact_Sales", [*ROWS["Fact_Sales"], f"{later},S001,P00001,10,7,2,10.0,0,,,Sunny,9.0,20.0,50,0,70.0"])
    put(source, "Dim_Store", ["S001,Renamed,Pune,MH,West,Large,WH01"])
    third = {t.table: t for t in ingest.ingest(spark, settings).tables}
    assert (third["Fact_Sales"].rows, third["Fact_Sales"].late_rows, third["Fact_Sales"].watermark) == (1, 4, str(later))
    assert third["Dim_Store"].reason == "changed_snapshot"
    out = curate.curate(spark, settings)
    demand = spark.read.parquet(f"{out.path}/dataset=demand_features").orderBy("date").collect()
    assert [r.units_sold for r in demand] == [1, 2, 3, 4, 7]
    assert {r.store_name for r in demand} == {"Renamed"}
    assert [r.promotion_id for r in demand] == ["PROMO0001", "PROMO0001", None, None, None]
    assert [r.units_sold_lag_1d for r in demand] == [None, 1, 2, 3, 4]
    assert demand[0].product_name == 'Big, "red" box' and demand[0].is_holiday
    assert publish.sealed(spark, out.path)
    order = spark.read.parquet(f"{out.path}/dataset=purchase_order_features").first()
    assert (order.expected_lead_time_days, order.lead_time_variance_days, order.order_value_at_cost, order.is_pending) == (4, 1, 15.0, True)
    assert len(spark.read.parquet(f"{out.path}/dataset=demand_features").columns) == 130
    assert run.audit(spark).count() == 11


def test_column_counts(spark, feed):
    _, settings = feed
    ingest.ingest(spark, settings)
    from granary.operators import enrich
    from granary.sources.csv import raw_bundle

    t = curate.latest(raw_bundle(spark, settings.raw_root))
    assert len(enrich.demand_base(t, enrich.calendar(t["Dim_Date"], t["Holiday"])).columns) == 76
    assert len(enrich.purchase_orders(t).columns) == 29


@pytest.mark.parametrize(
    ("table", "rows", "message"),
    [
        ("Dim_Warehouse", ["WH01,House,Pune,MH,West,1.5"], "invalid integer values in Dim_Warehouse.Capacity_Units: count=1"),
        ("Dim_Warehouse", ["WH01,  ,Pune,MH,West,5"], "Dim_Warehouse.Warehouse_Name: 1 missing values"),
        ("Dim_Warehouse", ["W1,House,Pune,MH,Nowhere,0"], "Warehouse_ID.format=1; Region.domain=1; Capacity_Units.minimum=1"),
        ("Promotion", ["PROMO0001,Spring,2024-01-03,2024-01-02,0.25"], "promotion.date_sequence=1"),
        ("Fact_Inventory", [f"{DAYS[0]},S001,P00001,20,5,1,0,18"], "inventory.stock_balance=1"),
    ],
)
def test_bad_rows_stop_a_table(spark, feed, table, rows, message):
    source, settings = feed
    put(source, table, rows)
    with pytest.raises(ingest.IngestError, match=message.replace(".", r"\.")):
        ingest.ingest(spark, settings, tables=[table])
    assert not (Path(settings.raw_root) / f"table={table}").exists()


def test_failures_can_be_collected(spark, feed):
    source, settings = feed
    put(source, "Holiday", ["2024-01-01"], header="Date,Name")
    soft = Settings(**{**settings.__dict__, "fail_fast": False})
    run = ingest.ingest(spark, soft, tables=["Holiday", "Dim_Store"])
    assert [t.status for t in run.tables] == ["failed", "loaded"] and "missing ['Holiday_Name']" in run.failures["Holiday"]


def test_duplicates_and_policies(spark, feed):
    source, settings = feed
    put(source, "Holiday", ["2024-01-01,First", "2024-01-01,Second"])
    run = ingest.ingest(spark, settings, tables=["Holiday"]).tables[0]
    assert (run.rows, run.duplicates) == (1, 1)
    assert spark.read.parquet(run.path).first().Holiday_Name == "First"
    with pytest.raises(ingest.IngestError, match="repeat a key"):
        ingest.ingest(spark, settings, tables=["Holiday"], full=True, reject_duplicates=True)
    policy = {"Fact_Sales": MissingPolicy({"Holiday": OnMissing.DROP_ROW})}
    assert ingest.ingest(spark, settings, tables=["Fact_Sales"], policies=policy).tables[0].status == "empty"
    with pytest.raises(ingest.IngestError, match="no fill value"):
        ingest.ingest(spark, settings, tables=["Fact_Sales"], full=True, policies={"Fact_Sales": MissingPolicy({"Holiday": OnMissing.FILL})})


def test_discovery(spark, feed):
    source, settings = feed
    (source / "Weather.csv").unlink()
    with pytest.raises(SourceError, match="Weather"):
        ingest.ingest(spark, settings)
    with pytest.raises(SourceError, match="unknown tables"):
        ingest.ingest(spark, settings, overrides={"Nope": "x"})
    with pytest.raises(KeyError):
        contract("Nope")


def test_publication_is_guarded(spark, tmp_path):
    df = spark.range(3)
    publish.publish_raw(df, str(tmp_path), "T", "run1")
    with pytest.raises(publish.PublishError, match="exists"):
        publish.publish_raw(df, str(tmp_path), "T", "run1")
    assert not list((tmp_path / "_staging").rglob("*.parquet"))
    with pytest.raises(publish.PublishError, match="missing"):
        publish.publish({"weather": df}, str(tmp_path), "run2")
    with pytest.raises(publish.PublishError):
        publish._abort(spark, str(tmp_path), str(tmp_path / "table=T"))
    with pytest.raises(ValueError):
        publish.WriteOptions(codec="bzip9")
    for codec in publish.CODECS:
        publish.write(df, str(tmp_path / codec), publish.Output(), publish.WriteOptions(codec=codec))
        assert spark.read.parquet(str(tmp_path / codec)).count() == 3


def test_retry_and_settings():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("reset")
        return "done"

    pauses = []
    assert Retry(jitter_s=0).call(flaky, pauses.append) == "done" and pauses == [0.5, 1.0]
    with pytest.raises(ValueError):
        Retry().call(lambda: int("x"), pauses.append)
    with pytest.raises(ValueError, match="overlap"):
        Settings(raw_root="/a/b", curated_root="/a", checkpoint_root="/c")
    secret = {"db_password": 1, "Set-Cookie": 2, "DATABASE_URL": "postgres://u:p@h", "session token": 4, "x": 5}
    assert redacted({"a": [secret], "API-Key": 3}) == {"a": [dict.fromkeys(secret, "[REDACTED]") | {"x": 5}], "API-Key": "[REDACTED]"}
    for message in ("Please Slow Down.", "503 SlowDown", "Request timeout", "Throttling: rate", "Service Unavailable"):
        assert passing(RuntimeError(message))
    assert not passing(RuntimeError("no such column"))
    import logging

    record = logging.LogRecord("granary", 20, "f", 1, "hello", (), None)
    record.fields = {"token": "t"}
    assert json.loads(JsonLines().format(record))["fields"] == {"token": "[REDACTED]"}


def test_settings_from_variables_and_files(tmp_path):
    (tmp_path / ".env").write_text("# folders\nexport GRANARY_RAW_ROOT='raw layer'\nGRANARY_CURATED_ROOT=s3a://b/c\n\nGRANARY_RETRY_ATTEMPTS=7\n")
    env = {
        "GRANARY_CHECKPOINT_ROOT": "/marks", "GRANARY_RETRY_ATTEMPTS": "3", "GRANARY_RETRY_FIRST_S": "0.1", "GRANARY_FEATURES_LAGS": "7, 1", "GRANARY_FEATURES_ABC": "0.7,0.9",
        "GRANARY_WRITE_CODEC": "zstd", "GRANARY_WRITE_TARGET_PARTITIONS": "4", "GRANARY_FAIL_FAST": "no", "GRANARY_STORE_PARTITIONS": "12", "OTHER": "x",
    }
    got = from_env(env, file=str(tmp_path / ".env"), root="/data", environment="test")
    assert (got.raw_root, got.curated_root, got.checkpoint_root, got.source_root) == ("/data/raw layer", "s3a://b/c", "/marks", "")
    assert (got.retry.attempts, got.retry.first_s, got.features.lags, got.features.abc) == (3, 0.1, (1, 7), (0.7, 0.9))
    more = from_env(env | {"GRANARY_CSV_SEP": ";", "GRANARY_CSV_ENCODING": "latin-1", "GRANARY_SPARK_MASTER": "yarn", "GRANARY_SPARK_SHUFFLE_PARTITIONS": "9"}, file=str(tmp_path / ".env"))
    assert (more.csv, more.spark.master, more.spark.shuffle_partitions) == (csv.Format(";", "latin-1"), "yarn", 9)
    with pytest.raises(ValueError, match="log level"):
        from_env(env | {"GRANARY_SPARK_LOG_LEVEL": "loud"}, file=str(tmp_path / ".env"))
    assert (got.write.codec, got.write.target_partitions, got.fail_fast, got.store_partitions, got.environment) == ("zstd", 4, False, 12, "test")
    with pytest.raises(ValueError, match="GRANARY_RETRY_ATTEMPTS"):
        from_env(env | {"GRANARY_RETRY_ATTEMPTS": "many"}, file=str(tmp_path / ".env"))
    with pytest.raises(ValueError, match="rise"):
        from_env(env | {"GRANARY_FEATURES_ABC": "0.9,0.7"}, file=str(tmp_path / ".env"))
    (tmp_path / "bad").write_text("A=1\nnothing\n")
    with pytest.raises(ValueError, match="line 2"):
        env_file(str(tmp_path / "bad"))


def test_a_crash_leaves_a_whole_checkpoint(spark, tmp_path, monkeypatch):
    store = checkpoints.CheckpointStore(spark, str(tmp_path))
    mark = lambda n: checkpoints.Checkpoint("T", csv.Identity("p", n, n), f"2024-01-0{n}", f"run{n}", "now")
    assert store.load("T") is None
    for n in (1, 2):
        store.save(mark(n))
        assert store.load("T") == mark(n)
    assert len(list((tmp_path / "T").glob("*.json"))) == 1

    def crash(*_):
        raise OSError("gone")

    def put_text(path, text):
        path.write_text(text)
        (path.parent / f".{path.name}.crc").unlink(missing_ok=True)

    with monkeypatch.context() as m:  # after the write, before the rename
        m.setattr(checkpoints.CheckpointStore, "_place", crash)
        with pytest.raises(OSError):
            store.save(mark(3))
    assert store.load("T") == mark(2)
    old = next((tmp_path / "T").glob("*.json"))
    text = old.read_text()
    store.save(mark(4))
    put_text(old, text)  # after the rename, before the old one is deleted
    assert store.load("T") == mark(4)
    store.save(mark(5))
    assert store.load("T") == mark(5) and len(list((tmp_path / "T").glob("*.json"))) == 1
    put_text(next((tmp_path / "T").glob("*.json")), "{")
    with pytest.raises(checkpoints.CheckpointError):
        store.load("T")
    with pytest.raises(checkpoints.CheckpointError):
        store.load("../T")


def bytes_read(spark) -> int:
    found = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(s.getBytesRead() for s in found if s.getScheme() == "file")


def test_one_file_makes_many_tasks_and_two_scans(spark, feed):
    source, settings = feed
    rows = [f"{dt.date(2000, 1, 1) + dt.timedelta(days=k)},S{s:03d},P00001,20,5,1,0,19" for k in range(12_000) for s in range(8)]
    rows += rows[:10]
    put(source, "Fact_Inventory", rows)
    path, spec = str(source / "Fact_Inventory.csv"), contract("Fact_Inventory")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    try:
        assert csv.scan(spark, path, spec).rdd.getNumPartitions() > 4
        before = bytes_read(spark)
        run = ingest.ingest(spark, settings, tables=["Fact_Inventory"]).tables[0]
        assert (run.rows, run.duplicates) == (96_000, 10)
        # two scans; each part reads some way into the next
        assert bytes_read(spark) - before < 2.8 * Path(path).stat().st_size
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_values_with_line_breaks_and_first_rows(spark, feed):
    source, settings = feed
    put(source, "Dim_Product", ['P00001,"Two\nlines, ""so""",Box,Toys,Sub,Acme,5.0,9.0,1,2,30,SUP001,1.0,2.0', *ROWS["Dim_Product"]])
    path, spec = str(source / "Dim_Product.csv"), contract("Dim_Product")
    assert csv.lines(spark, path) == csv.Lines(None, True) and csv.lines(spark, str(source / "Dim_Store.csv")) == csv.Lines(1, False)
    run = ingest.ingest(spark, settings, tables=["Dim_Product"]).tables[0]
    assert (run.rows, run.duplicates) == (1, 1)
    assert spark.read.parquet(run.path).first().Product_Name == 'Two\nlines, "so"'
    with pytest.raises(Exception, match="(?i)malformed"):
        csv.scan(spark, path, spec, line_breaks=False).collect()


@pytest.mark.parametrize(("form", "suffix"), [(csv.Format(";", "ISO-8859-1"), "latin-1"), (csv.Format("\t", "UTF-16"), "utf-16")])
def test_feeds_of_other_delimiters_and_encodings(spark, feed, form, suffix):
    source, settings = feed
    rows = ["WH01;Häuser, rot;Pune;MH;West;1000", "WH02;Depot;Pune;MH;East;5", "", "WH02;Again;Pune;MH;East;5"]
    text = "\n".join([";".join(contract("Dim_Warehouse").columns), *rows]) + "\n"
    (source / "Dim_Warehouse.csv").write_bytes(text.replace(";", form.sep).encode(suffix))
    run = ingest.ingest(spark, Settings(**{**settings.__dict__, "csv": form}), tables=["Dim_Warehouse"]).tables[0]
    assert (run.status, run.rows, run.duplicates) == ("loaded", 2, 1)
    assert {r.Warehouse_Name for r in spark.read.parquet(run.path).collect()} == {"Häuser, rot", "Depot"}
    with pytest.raises(SourceError, match="header"):
        ingest.ingest_table(spark, contract("Dim_Warehouse"), str(source / "Dim_Warehouse.csv"), settings, checkpoints.CheckpointStore(spark, settings.checkpoint_root + "2"), "r")
    for bad in ("", ";;", '"'):
        with pytest.raises(SourceError):
            csv.Format(bad)
    with pytest.raises(SourceError, match="encoding"):
        csv.Format(encoding="none-such")


def test_counts_of_tasks_that_ran_twice_are_taken_again(spark, feed, monkeypatch):
    source, settings = feed
    put(source, "Dim_Warehouse", [f"WH{k:02d},House,Pune,MH,West,1000" for k in range(1, 9)] + ["WH01,Again,Pune,MH,West,1000"])
    plain = ingest._told
    monkeypatch.setattr(ingest, "_told", lambda o, c: {k: 2 * v if isinstance(v, int) else v for k, v in plain(o, c).items()})
    run = ingest.ingest(spark, settings, tables=["Dim_Warehouse"]).tables[0]
    assert (run.rows, run.duplicates) == (8, 1)


def test_contracts_cover_the_feed():
    assert list(CONTRACTS) == list(ROWS)
    assert all(set(s.key) <= set(s.columns) and len(set(map(snake, s.columns))) == len(s.columns) for s in CONTRACTS.values())
    assert [f.name for s in CONTRACTS.values() for f in s.schema if not f.metadata["required"]] == ["Promotion", "Holiday"]


def test_stream_takes_each_row_once(spark, tmp_path):
    spec = contract("Fact_Inventory")
    source = tmp_path / "in"
    source.mkdir()
    rows = ROWS["Fact_Inventory"]
    head = ",".join(spec.columns)
    (source / "a.csv").write_text("\n".join([head, *rows, rows[0], "2024-01-09,S001,P00001,x,0,0,0,0"]) + "\n")
    for _ in range(2):
        query = continuous.follow(spark, str(source), str(tmp_path / "out"), spec)
        assert query.awaitTermination(120)
        (source / "b.csv").write_text("\n".join([head, rows[1]]) + "\n")
    # a row of long ago comes late and is taken, a stored key isn't
    (source / "c.csv").write_text("\n".join([head, "2001-01-01,S001,P00001,20,5,1,0,19", rows[2]]) + "\n")
    assert continuous.follow(spark, str(source), str(tmp_path / "out"), spec).awaitTermination(120)
    stored = spark.read.parquet(str(tmp_path / "out/rows"))
    assert stored.count() == 5 and stored.select(*spec.key).distinct().count() == 5
    assert spark.read.parquet(str(tmp_path / "out/rejects/*")).count() == 1


def test_streams_of_sales_and_offers_meet(spark, tmp_path):
    """Equal to the batch join, whichever side comes first; a sale behind the watermark is dropped and counted."""
    day = lambda k: dt.date(2024, 1, 1) + dt.timedelta(days=k)
    sales = [(k, day(k % 40), ["Spring", "Other", None][k % 3]) for k in range(120)]
    offers = [(f"O{k}", "Spring" if k % 2 else "Other", day(k), day(k + 5 * (k % 4))) for k in range(40)] + [("long", "Spring", day(0), day(95)), ("back", "Spring", day(9), day(8))]
    kinds = {"sales": "n int, date date, sales_promotion string", "offers": "promotion_id string, promotion_name string, start_date date, end_date date"}
    for name in kinds:
        (tmp_path / name).mkdir()

    def put_rows(name, part, rows):
        spark.createDataFrame(rows, kinds[name]).coalesce(1).write.mode("append").parquet(str(tmp_path / name))

    def run():
        streams = [spark.readStream.schema(k).parquet(str(tmp_path / n)) for n, k in kinds.items()]
        out = continuous.promoted(*streams, delay="50 days", ahead_days=90)
        query = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "marks")).trigger(availableNow=True).start()
        assert query.awaitTermination(120)
        return continuous.late_rows(query)

    put_rows("sales", 0, sales[:60])
    put_rows("offers", 0, offers[:10])
    assert run() == 0
    put_rows("offers", 1, offers[10:])
    put_rows("sales", 1, sales[60:])
    assert run() == 0
    want = sorted((n, o[0]) for n, d, label in sales for o in offers if o[1] == label and o[2] <= d <= o[3] and (o[3] - o[2]).days < 90)
    assert sorted((r.n, r.promotion_id) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == want
    for part, rows in enumerate(([(500, day(300), "Spring")], [(501, day(301), "Spring"), (502, day(1), "Spring")])):
        put_rows("sales", part, rows)
        put_rows("offers", part, [(f"far{part}", "None", day(300 + part), day(300 + part))])
        late = run()
    assert late >= 1
