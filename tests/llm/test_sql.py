"""Operators that SQL can express, against it."""

import compare
import pytest

from kerbside.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", list(ORACLE))
@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_as_sql(spark, name, folder):
    assert compare.differences(QUERIES[name](spark, folder), compare.connect(folder), ORACLE[name]) == ""
