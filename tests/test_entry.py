"""The driver contract: entry() runs on sf0.001 with the report schema."""

import __spark_entry__ as entry
from cardwatch import schemas as S


def test_entry_returns_report(spark):
    df = entry.entry(spark)
    assert [f.name for f in df.schema.fields] == S.REP_FRAUD.fieldNames()
    rows = df.collect()
    assert len(rows) > 0
    assert all(r.event_type in (1, 2, 3) for r in rows)


def test_entry_schema_is_stable(spark):
    a, b = entry.entry(spark).schema, entry.entry(spark).schema
    assert a == b
