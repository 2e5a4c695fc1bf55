"""Date and timestamp queries do not depend on the session time zone."""

from __future__ import annotations

import duckdb

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.test_queries import _rows


def test_non_utc_session_matches_oracle(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    con = duckdb.connect()
    for t in ("customer", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name in ("silver_transaction", "normalize_dates", "date_keys", "lift_fact_events", "month_ends"):
        sp = E.queries()[name](other, SF_SMALL).toPandas()
        dp = con.sql(E.oracle_sql()[name]).df()
        cols = sorted(sp.columns)
        assert _rows(sp, cols) == _rows(dp, cols), name
