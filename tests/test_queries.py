import os
import subprocess
import sys
from pathlib import Path

import compare
import pytest

import __spark_entry__ as contract


ROOT = Path(__file__).resolve().parent.parent


def test_every_sql_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.fixture(scope="module")
def duck(small):
    return compare.duck(small)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, small, duck, name):
    df = contract.queries()[name](spark, small)
    assert compare.differences(df, contract.oracle_sql()[name], duck) is None


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_query_gives_rows(spark, small, name):
    assert contract.queries()[name](spark, small).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_range_reaches_the_scan(spark, small):
    text = plan(contract.queries()["scan_range"](spark, small))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


def test_only_needed_columns_are_read(spark, small):
    text = plan(contract.queries()["replay_offset"](spark, small))
    assert "props" not in text and "value:double" not in text


@pytest.mark.parametrize("name", ["route_messages", "conform_ignore", "dead_letter_rows", "typed_projection_lenient"])
def test_event_path_has_no_shuffle_and_no_python(spark, small, name):
    text = plan(contract.queries()[name](spark, small))
    # A small file may be dealt out to all cores; nothing else moves rows.
    assert text.count("Exchange") == text.count("Exchange RoundRobinPartitioning")
    assert "Python" not in text and "Arrow" not in text


def test_workers_find_the_package_from_anywhere(tmp_path):
    """A session that knows nothing of the repository, started in another folder."""
    code = (
        f"import sys; sys.path.insert(0, {str(ROOT)!r}); import __spark_entry__ as e; from pyspark.sql import SparkSession; "
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', False).getOrCreate(); "
        "print('rows', e.queries()['batch_infer'](s, '/root/testdata/sf0.001').count())"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 1500" in done.stdout, done.stderr[-2000:]
