"""Every registered query outside ``outpost.llm`` on the smallest tables, against results that its SQL text gave in
another engine when they were written down (``expected.json``)."""

import json
import os

import __spark_entry__ as entry
import pytest
from outpost.plans import registry
from rows import digest

SF = "/root/testdata/sf0.001"
with open(os.path.join(os.path.dirname(__file__), "expected.json")) as f:
    EXPECTED = json.load(f)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_a_text_and_a_result():
    assert set(registry.queries()) == set(registry.oracle_sql()) == set(EXPECTED)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_result(spark, name):
    assert digest(registry.queries()[name](spark, SF)) == EXPECTED[name]
