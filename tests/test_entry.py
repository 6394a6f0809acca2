"""Driver contract: entry() runs, every query has an oracle or is rows-only by design,
and a sample of queries matches DuckDB on sf0.001."""
import duckdb
import pytest

import __spark_entry__ as E
from saleswh.catalog import load_all
from tests.conftest import SMALL

ROWS_ONLY = set()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"YEAR", "MONTH", "SALES_ORG_NAME", "PRODUCT_LINE", "VENTA_NETA", "CANTIDAD"} == set(df.columns)


def test_every_query_has_oracle_or_is_rows_only():
    q, s = load_all(), E.oracle_sql()
    assert set(q) - set(s) == ROWS_ONLY
    assert set(s) <= set(E.queries())


def _rows(pdf):
    import pandas as pd
    cols = sorted(pdf.columns)
    out = []
    for r in pdf[cols].itertuples(index=False):
        out.append(tuple(None if (v is None or v is pd.NA or (isinstance(v, float) and v != v))
                         else (round(v, 6) if isinstance(v, float) else v) for v in r))
    return cols, sorted(out, key=repr)


@pytest.mark.parametrize("name", ["monthly_sales", "run_dq_checks", "scd2_customer_hash", "silver_rule_hits",
                                  "odata_roundtrip", "top_drivers"])
def test_matches_oracle_small(spark, name):
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem documents").split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    got = _rows(E.queries()[name](spark, SMALL).toPandas())
    exp = _rows(con.sql(E.oracle_sql()[name]).df())
    assert got == exp
