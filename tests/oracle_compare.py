"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from decimal import Decimal

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if v != v else repr(0.0 if v == 0 else v)
    if isinstance(v, Decimal):
        return format(v.normalize(), "f") if v != 0 else "0"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def rows(table):
    cols = sorted(table.column_names)
    data = [table.column(c).to_pylist() for c in cols]
    return sorted("|".join(_norm(col[i]) for col in data) for i in range(table.num_rows))


def assert_same(spark_arrow, duck_arrow):
    assert sorted(spark_arrow.column_names) == sorted(duck_arrow.column_names)
    st = {f.name: str(f.type) for f in spark_arrow.schema}
    dt = {f.name: str(f.type) for f in duck_arrow.schema}
    assert st == dt
    assert spark_arrow.num_rows == duck_arrow.num_rows
    assert rows(spark_arrow) == rows(duck_arrow)
