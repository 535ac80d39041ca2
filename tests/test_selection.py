"""Record filters, run dates and layer reading."""

import pytest

from beatloom.functions.hrv import valid_run_date as date_column
from beatloom.plans.run import valid_run_date
from beatloom.sources.records import RecordFilterError, filter_records, parse_record_filter
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def available(spark):
    return spark.createDataFrame([(r,) for r in ["100", "101", "102", "0101", "x"]], "record_id string")


def ids(df):
    return sorted(r.record_id for r in df.collect())


def test_filters(available):
    assert ids(filter_records(available)) == ["0101", "100", "101", "102", "x"]
    assert ids(filter_records(available, ids="100, 101,,102")) == ["100", "101", "102"]
    assert ids(filter_records(available, ids="100, 101,,102", limit=2)) == ["100", "101"]
    assert ids(filter_records(available, ids="x", range="100-102")) == ["x"]
    assert ids(filter_records(available, range="100-102")) == ["100", "101", "102"]
    assert ids(filter_records(available, range=" 101 - 500 ", limit="1")) == ["101"]
    # The limit cuts the request before it meets the records.
    with pytest.raises(RecordFilterError):
        filter_records(available, ids="7,100", limit=1)


@pytest.mark.parametrize(
    "arguments",
    [
        {"ids": ",,"}, {"range": "100"}, {"range": "a-b"}, {"range": "102-100"},
        {"ids": "100", "limit": 0}, {"ids": "100", "limit": "x"}, {"limit": 3},
    ],
)
def test_bad_filters(arguments):
    with pytest.raises(RecordFilterError):
        parse_record_filter(**arguments)


def test_no_match(available):
    with pytest.raises(RecordFilterError):
        filter_records(available, ids="999")
    assert filter_records(available, ids="999", require_match=False).isEmpty()


def test_requested_frame(spark):
    assert ids(parse_record_filter(ids="b,a,b").frame(spark)) == ["a", "b"]
    assert ids(parse_record_filter(range="9-11").frame(spark)) == ["10", "11", "9"]


def test_filter_reaches_the_scan(spark, available, tmp_path):
    path = str(tmp_path / "by_record")
    available.withColumn("v", F.lit(1)).write.partitionBy("record_id").parquet(path)
    table = spark.read.schema("record_id string, v int").parquet(path)
    plan = filter_records(table, range="100-102")._jdf.queryExecution().executedPlan().toString()
    assert "record_id" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]


DATES = {
    "2024-02-29": True, "2023-02-29": False, "2024-1-001": False, "20240101ab": False, "": False,
    "2024-12-31": True, "2024-13-01": False, "2024-01-1": False, None: False,
}


def test_dates(spark):
    rows = spark.createDataFrame([(d,) for d in DATES], "d string")
    got = {r.d: r.v for r in rows.withColumn("v", date_column(F.col("d"))).collect()}
    assert got == DATES
    assert {d: valid_run_date(d) for d in DATES} == DATES
