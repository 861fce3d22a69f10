"""Sealed snapshots, features refreshed from changes, and publication with a fault at each step."""

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from granary.operators import features
from granary.plans import refresh
from granary.plans.settings import Retry
from granary.sources import publish
from granary.sources.snapshots import Conflict, Dataset, SnapshotError


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


@pytest.fixture
def sales(spark):
    made = [(k, ["a b", "x=y", None, "é/%"][k % 4], None if k == 7 else dt.date(2024, 1, 1) + dt.timedelta(days=k)) for k in range(40)]
    return spark.createDataFrame(made, "k int, p string, date date")


def test_versions_partitions_and_bounds(spark, sales, tmp_path):
    d = Dataset(spark, str(tmp_path / "d"), ("p",), "date")
    assert d.manifest() is None
    with pytest.raises(SnapshotError, match="no sealed version"):
        d.read()
    first = d.commit(sales.repartition(1), "r1")
    assert first.version == 1 and sum(f.rows for f in first.files) == 40 and all(f.bytes > 0 for f in first.files)
    assert rows(d.read(), "k") == rows(sales, "k")
    assert rows(d.read(partitions=[{"p": None}, {"p": "é/%"}]), "k") == rows(sales.where("p is null or p = 'é/%'"), "k")
    span = (dt.date(2024, 1, 10), dt.date(2024, 1, 12))
    assert rows(d.read(between=span), "k") == rows(sales.where(F.col("date").between(*span)), "k")
    # one partition replaced: the files of the others are the same
    second = d.commit(sales.where("p = 'x=y'").withColumn("k", F.col("k") + 100), "r2", replace=[{"p": "x=y"}])
    kept = {f.path for f in first.files if f.partition["p"] != "x=y"}
    assert kept < {f.path for f in second.files} and second.version == 2
    assert sorted(r.k for r in d.read().collect()) == sorted(k + 100 * (k % 4 == 1) for k in range(40))
    assert rows(d.read(version=1), "k") == rows(sales, "k")
    third = d.commit(sales.limit(0), "r3", replace=[{"p": None}])
    assert len({f.partition["p"] for f in third.files}) == 3 and d.read().where("p is null").count() == 0
    with pytest.raises(SnapshotError, match="aren't replaced"):
        d.commit(sales, "r4", replace=[{"p": None}])
    with pytest.raises(SnapshotError, match="same schema"):
        d.commit(sales.drop("k"), "r5", replace=[{"p": None}])
    with pytest.raises(SnapshotError, match="used once"):
        d.commit(sales, "r1")
    assert d.commit(sales.limit(0), "r6").files == () and d.read().count() == 0 and d.read().columns == sales.columns


def test_files_are_skipped_by_their_bounds(spark, tmp_path):
    d = Dataset(spark, str(tmp_path / "d"), bounds="date")
    days = spark.range(1000).select(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("date"), "id")
    made = d.commit(days.repartitionByRange(20, "date"), "r1")
    span = (dt.date(2021, 1, 1), dt.date(2021, 1, 31))
    assert len(made.files) == 20 and len(d.chosen(made, between=span)) <= 2 and d.read(between=span).count() == 31
    assert d.read(between=(dt.date(2030, 1, 1), dt.date(2030, 1, 2))).count() == 0


def test_numbers_are_no_text(spark, tmp_path):
    for name, kind in (("a", "int"), ("b", "decimal(9,2)"), ("c", "double")):
        d = Dataset(spark, str(tmp_path / name), bounds="x")
        made = d.commit(spark.range(-50, 1000).select(F.col("id").cast(kind).alias("x")).repartitionByRange(10, "x"), "r1")
        assert d.read(between=(9, 100)).count() == 92 and len(d.chosen(made, between=(9, 100))) < 4
        assert d.read(between=(-7, -7)).count() == 1


def test_files_of_a_stated_size(spark, tmp_path):
    df = spark.range(400_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x")).repartition(40)
    made = Dataset(spark, str(tmp_path / "d")).commit(df, "r1", file_bytes=8 << 20)
    assert len(made.files) < 12 and max(f.bytes for f in made.files) < 16 << 20
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB") != f"{8 << 20}b"


@pytest.mark.parametrize("step", ["_write", "_described", "_place"])
def test_a_run_that_fails_is_never_seen(spark, sales, tmp_path, monkeypatch, step):
    d = Dataset(spark, str(tmp_path / "d"), ("p",))
    d.commit(sales, "r1")
    plain = getattr(Dataset, step)

    def fail(self, *a):
        if step == "_write":
            plain(self, *a)
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(Dataset, step, fail)
        with pytest.raises(OSError):
            d.commit(sales.limit(3), "r2")
    assert d.versions() == [1] and d.read().count() == 40 and [p.name for p in (tmp_path / "d/data").iterdir()] == ["__run=r1"]
    assert d.commit(sales.limit(3), "r2").version == 2


def test_a_fault_after_the_seal_is_no_failure(spark, sales, tmp_path, monkeypatch):
    d = Dataset(spark, str(tmp_path / "d"))
    plain = Dataset._place

    def late(self, manifest):
        plain(self, manifest)
        raise OSError("no answer")

    monkeypatch.setattr(Dataset, "_place", late)
    assert d.commit(sales, "r1").run_id == "r1" and d.read().count() == 40


def test_of_two_writers_one_wins(spark, sales, tmp_path):
    d = Dataset(spark, str(tmp_path / "d"))
    d.commit(sales, "r1")
    seen = []

    def meanwhile(files):
        if not seen:
            seen.append(Dataset(spark, str(tmp_path / "d")).commit(sales.limit(5), "other"))

    with pytest.raises(Conflict):
        d.commit(sales.limit(7), "mine", before_sealing=meanwhile)
    assert d.read().count() == 5 and d.manifest().run_id == "other" and not (tmp_path / "d/data/__run=mine").exists()
    (tmp_path / "d/data/__run=crashed").mkdir()
    assert d.clean(keep=1) == ["__run=crashed", "__run=r1"] and d.versions() == [2] and d.read().count() == 5
    (next((tmp_path / "d/_versions").glob("*2.json"))).write_text("{")
    (tmp_path / "d/_versions/.000000000002.json.crc").unlink(missing_ok=True)
    with pytest.raises(SnapshotError, match="can't be read"):
        d.read()


# --- features kept up to date

FACT = "date date, store_id string, product_id string, units_sold long, revenue double"
C = features.FeatureConfig(lags=(1, 7), rolling=(2, 7), abc_days=10, xyz_days=12)


def compute(df):
    own = features.own_history(df, C, *features.HISTORY)
    shared = own.select("*", *[v.alias(k) for k, v in features.portfolio_features(C).items()])
    out = shared.select("*", *[v.alias(k) for k, v in features.class_features(C).items()]).drop("__day", "__better")
    return out.withColumns({"year": F.year("date"), "month": F.month("date")})


def facts(seed, days=400):
    r = random.Random(seed)
    return {(dt.date(2023, 1, 1) + dt.timedelta(days=d), s, p): (r.randint(0, 20), float(r.randint(0, 99))) for d in range(days) for s in ("S1", "S2") for p in "ABC" if r.random() < 0.8}


def frame(spark, fact):
    return spark.createDataFrame([(*k, *v) for k, v in fact.items()], FACT)


def test_refreshed_features_equal_a_full_run(spark, tmp_path):
    old = facts(1)
    new = dict(old)
    for k in [k for k in old if k[0] == dt.date(2023, 5, 3) and k[1] == "S1"]:
        new[k] = (99, 1.0)  # corrected
    del new[next(k for k in old if k[0] == dt.date(2023, 5, 20))]  # deleted
    new[(dt.date(2024, 2, 10), "S2", "A")] = (5, 5.0)  # after a gap
    new[(dt.date(2023, 8, 31), "S3", "Z")] = (5, 5.0)  # a new store
    fact, before = frame(spark, new), frame(spark, old)
    changed = frame(spark, {k: v for k, v in (new | old).items() if old.get(k) != new.get(k)})
    stored, source = Dataset(spark, str(tmp_path / "features"), ("year", "month"), "date"), Dataset(spark, str(tmp_path / "fact"), bounds="date")
    first = stored.commit(compute(before), "f1")
    source.commit(fact.repartitionByRange(12, "date"), "s1")
    second = refresh.refresh_stored(stored, source, changed, C, compute, "f2")
    assert rows(stored.read().select(*compute(fact).columns), "date", "store_id", "product_id") == rows(compute(fact), "date", "store_id", "product_id")
    again = {(f.partition["year"], f.partition["month"]) for f in second.files if f.path.startswith("data/__run=f2/")}
    assert again == {("2023", "5"), ("2023", "6"), ("2023", "8"), ("2023", "9"), ("2024", "2")}
    assert {f.path for f in second.files} - {f.path for f in first.files} == {f.path for f in second.files if "f2" in f.path}
    assert refresh.refresh_stored(stored, source, changed.limit(0), C, compute, "f3") is None


def test_only_a_bounded_share_of_days_is_computed(spark):
    fact = frame(spark, facts(2))
    seen = []

    def watched(df):
        seen.append({r[0] for r in df.select("date").distinct().collect()})
        return compute(df)

    change = spark.createDataFrame([(dt.date(2023, 6, 1), "S1", "A", 1, 1.0)], FACT)
    out = refresh.refresh(fact, compute(fact), refresh.touched(change, C), C, watched)
    assert max(seen[0]) - min(seen[0]) <= dt.timedelta(days=2 * C.reach)
    assert rows(out, "date", "store_id", "product_id") == rows(compute(fact).select(out.columns), "date", "store_id", "product_id")
    touched = refresh.touched(change.unionByName(change), C)
    assert touched.count() == C.reach + 1


def test_increment_after_increment(spark):
    """Months that come one after another, as a feed brings them."""
    whole = facts(3, 150)
    known: dict = {}
    stored = compute(frame(spark, {}))
    for end in (60, 61, 100, 150):
        last = dt.date(2023, 1, 1) + dt.timedelta(days=end)
        new = {k: v for k, v in whole.items() if k[0] < last and k not in known}
        known |= new
        stored = refresh.refresh(frame(spark, known), stored, refresh.touched(frame(spark, new), C), C, compute).cache()
    assert rows(stored, "date", "store_id", "product_id") == rows(compute(frame(spark, whole)).select(stored.columns), "date", "store_id", "product_id")


# --- publication


@pytest.mark.parametrize("in_place", [False, True])
@pytest.mark.parametrize("step", ["write", "_put", "_move"])
@pytest.mark.parametrize("after", [False, True])
def test_one_passing_fault_at_each_step_ends_sealed(spark, tmp_path, monkeypatch, in_place, step, after):
    if in_place and step == "_move":
        pytest.skip("nothing is moved")
    bundle = {n: spark.range(2).select("id", F.lit(1).alias("year"), F.lit(1).alias("month"), F.lit(1).alias("order_year"), F.lit(1).alias("order_month")) for n in publish.CURATED}
    plain, calls = getattr(publish, step), []
    options = publish.WriteOptions(in_place=in_place)
    run = lambda: publish.publish(bundle, str(tmp_path), "run1", options)

    def once(*a):
        calls.append(1)
        if len(calls) == (3 if step == "write" else 1):
            if after:
                plain(*a)
            raise OSError("passing")
        return plain(*a)

    with monkeypatch.context() as m:
        m.setattr(publish, step, once)
        with pytest.raises(OSError):
            Retry(attempts=1).call(run)
        found = list(Path(tmp_path).glob("processing_date=*/run_id=run1"))
        assert all(publish.sealed(spark, str(p)) for p in found)  # nothing visible, or sealed
        path = Retry(jitter_s=0, first_s=0).call(run)
    assert publish.sealed(spark, path) and spark.read.parquet(f"{path}/dataset=weather").count() == 2
    assert run() == path and not list((tmp_path / "_staging").rglob("*.parquet"))
