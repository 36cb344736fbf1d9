"""Every registered query against its SQL oracle (DuckDB) on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from strata.plans import registry
from tools.compare import canon

SF = "/root/testdata/sf0.001"
NAMES = sorted(registry.queries())
DUCK_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
             "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    scols, srows = canon(df.columns, df.collect())
    rel = duck.sql(E.oracle_sql()[name])
    otypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    stypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert {c: DUCK_TYPE.get(t, t.upper()) for c, t in stypes.items()} == otypes
    res = duck.execute(E.oracle_sql()[name])
    ocols, orows = canon([d[0] for d in res.description], res.fetchall())
    assert scols == ocols
    assert len(srows) == len(orows)
    assert srows == orows
