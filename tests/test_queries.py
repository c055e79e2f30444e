"""Every registered query against its SQL: on the smallest test tables, and on skewed ones."""

import pytest

from __spark_entry__ import entry
from caselog.testbed import ORACLES, QUERIES
from caselog.testbed.adapters import case_log, vocabulary_log
from tests.compare import differences, oracle_connection
from tests.skew import build

SMALL = "/root/testdata/sf0.001"
MODELS_ON_SKEW = [
    "stg_reports",
    "stg_applications",
    "stg_descriptors",
    "headline_outcomes",
    "latest_per_key",
    "land_incremental",
    "clustered_write",
    "star_join",
    "reconcile_rows",
    "check_relationship",
    "envelope_rows",
]


@pytest.fixture(scope="session")
def small_oracle():
    return oracle_connection(SMALL)


@pytest.fixture(scope="session")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skew"))
    build(folder)
    return folder, oracle_connection(folder)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, small_oracle, name):
    result = differences(spark, small_oracle, QUERIES[name], ORACLES[name], SMALL)
    # A check or filter may find nothing on this little data; what counts is that both agree.
    assert result in (None, "no rows on either side")


@pytest.mark.parametrize("name", [*MODELS_ON_SKEW, "check_not_null"])
def test_query_on_skewed_tables(spark, skewed, name):
    folder, con = skewed
    assert differences(spark, con, QUERIES[name], ORACLES[name], folder) is None


def test_no_row_is_dropped_and_no_record_depends_on_size(spark, skewed):
    folder = skewed[0]
    n_lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    revised = n_lines.where("l_orderkey % 10 = 0").count()
    assert case_log(spark, folder).count() == n_lines.count() + revised
    assert vocabulary_log(spark, folder).select("descriptor_ui").distinct().count() == spark.read.parquet(f"{folder}/part.parquet").count()


def test_repeated_lines_are_published_again(spark, tmp_path):
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet").where("l_orderkey % 10 <> 0").limit(700)
    lines.unionByName(lines.limit(50)).write.parquet(str(tmp_path / "lineitem.parquet"))
    assert case_log(spark, str(tmp_path)).count() == 750
    assert QUERIES["latest_version"](spark, str(tmp_path)).count() == lines.select("l_orderkey", "l_linenumber").distinct().count()


def test_entry(spark):
    row = entry(spark).collect()
    assert len(row) == 1 and row[0].cases > row[0].fatal_cases > 0
