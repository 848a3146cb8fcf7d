import __spark_entry__ as contract
from chunkwright.schemas import CHECK_NAMES
from workload import oracles
from workload.queries import QUERIES


def test_every_workload_query_has_an_oracle():
    # Merging byte pairs is beyond SQL: these two are held against the library in test_vocabulary.py.
    assert set(QUERIES) - {"vocabulary_tokens", "chunks_of_vocabulary_tokens"} == set(oracles.build())
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(CHECK_NAMES) == 12


def test_entry_returns_rows(spark):
    row = contract.entry(spark).first()
    assert row.total_generated == row.total_verified + row.total_rejected > 0
