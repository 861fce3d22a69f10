"""Every retail query against its SQL, on the smallest driver tables."""

import os

import duckdb
import pytest

from granary.operators import quality
from granary.plans import oracles, queries
from granary.plans.fixtures import DRIVER, frame

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def rows(values):
    number = lambda v: isinstance(v, int | float) and not isinstance(v, bool)
    return sorted(tuple("~" if v is None else repr(float(v)) if number(v) else str(v) for v in r) for r in values)


def test_every_query_has_an_oracle():
    assert queries.QUERIES.keys() == oracles.ORACLES.keys()


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_equals_its_sql(spark, con, name):
    sql = con.sql(oracles.oracle_sql()[name])
    df = queries.queries()[name](spark, SF)
    assert df.columns == sql.columns
    assert rows(map(tuple, df.collect())) == rows(sql.fetchall())


def test_every_rule_fires_on_some_rows_and_not_on_others(spark):
    """So that a rule that is always or never true can't pass."""
    found = {(r.table, r.rule): (r.failed_rows, r.n_rows) for r in queries.queries()["quality_every_rule"](spark, SF).collect()}
    own = {(t, rule) for t, rules in quality.BUSINESS.items() for rule in rules()}
    assert own <= found.keys()
    assert {k for k in ("required", "minimum", "maximum", "domain", "format") if any(rule.endswith(f".{k}") for _, rule in found)} == {"required", "minimum", "maximum", "domain", "format"}
    assert all(0 < failed < n for failed, n in found.values())


@pytest.mark.parametrize("name", ["contiguous_lags_dense_whole", "volatility_segment_whole"])
def test_dense_queries_take_the_whole_fact(spark, name):
    """Each key has every day from the fact's first to its last, so no sale is left out."""
    days = "(select cast(l_shipdate as date) as date from lineitem)"
    c = duckdb.connect()
    c.sql(f"create view lineitem as select * from '{SF}/lineitem.parquet'")
    first, last = c.sql(f"select min(date), max(date) from {days}").fetchall()[0]
    got = queries.queries()[name](spark, SF)
    keys = got.select("store_id", "product_id").distinct().count()
    assert {r.date for r in got.select("date").distinct().collect()} >= {r[0] for r in c.sql(f"select distinct date from {days}").fetchall()}
    assert got.count() == keys * ((last - first).days + 1)
    assert got.select("date", "store_id", "product_id").join(frame(spark, SF, "priced"), ["date", "store_id", "product_id"]).count() == frame(spark, SF, "priced").count()
