"""Every query with SQL equals it on the driver's tables; the others give one row per input row."""

import pytest

from compare import compare, duck
from placefolio.llm import queries


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    sql = queries.oracle_sql().get(name)
    if sql:
        assert compare(df, duck(sf_dir), sql) is None
    elif name.startswith(("op11", "op12")):
        # More rows than documents or vectors; tests of their own compare them.
        assert df.count() > 0
    else:
        tables = ("documents", "pages") if name.startswith("op3") else ("documents",)
        assert df.count() == sum(spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in tables)
