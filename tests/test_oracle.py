"""Every registered query with a check gives what the check gives."""

import checker
import pytest

import __spark_entry__ as entry_points

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return checker.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_equals_its_check(spark, con, name):
    frame = entry_points.queries()[name](spark, SF_DIR)
    assert checker.compare(frame, con, entry_points.oracle_sql()[name]) is None


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.columns == ["conv_id", "n_turns", "n_patient_lines", "patient_chars"] and frame.count() > 0
