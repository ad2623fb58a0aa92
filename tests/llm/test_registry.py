"""What the entry file registers."""

import __spark_entry__ as entry
from starmill.llm.queries import ORACLES, QUERIES


def test_every_operator_and_the_pipeline_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert all(isinstance(sql, str) for sql in entry.oracle_sql().values())
    assert set(ORACLES) < set(QUERIES) and set(entry.oracle_sql()) <= set(entry.queries())
