"""Sinks round-trip, clean names, entry point smoke check, oracle agreement."""

import os
import tempfile

import pytest

from conftest import SF001
from paritas import sinks
from paritas.plans.catalog import enroll, q_sink_csv_headless


def test_clean_names(spark):
    df = spark.createDataFrame([(1, "a")], "`NAME_OF_COLUMN(S)_X` int, `DEV TABLE VALUE` string")
    assert sinks.clean_names(df).columns == ["NAME_OF_COLUMNS_X", "DEV_TABLE_VALUE"]


def test_csv_roundtrip_keeps_null_and_empty_apart(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x")], "k int, v string")
    path = os.path.join(tempfile.mkdtemp(prefix="paritas-csv-"), "out")
    assert sinks.write_csv(df, path) == 3
    back = sinks.read_csv(spark, path, df.schema)
    assert sorted(back.collect()) == sorted(df.collect())


def test_csv_arrays_become_text(spark):
    df = spark.createDataFrame([(1, ["a", "b"])], "k int, cols array<string>")
    assert sinks.csv_ready(df).first().cols == '["a","b"]'


def test_headless_query_writes_from_all_tasks(spark, monkeypatch):
    """The result grows with the input, so it is not brought into one task."""
    write, single = sinks.write_csv, []

    def watched(df, path, header=True, single_file=False, skip_empty=False):
        single.append(single_file)
        return write(df, path, header, single_file, skip_empty)

    monkeypatch.setattr(sinks, "write_csv", watched)
    got, want = q_sink_csv_headless(spark, SF001), enroll(spark, SF001).count_differences
    assert single == [False] and sorted(got.collect()) == sorted(want.collect())


def test_single_file_without_header(spark):
    df = spark.range(100).repartition(5)
    path = os.path.join(tempfile.mkdtemp(prefix="paritas-csv-"), "out")
    assert sinks.write_csv(df, path, header=False, single_file=True) == 100
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1
    assert sinks.read_csv(spark, path, df.schema, header=False).count() == 100


def test_skip_empty_writes_nothing(spark):
    df = spark.createDataFrame([], "k int")
    path = os.path.join(tempfile.mkdtemp(prefix="paritas-csv-"), "out")
    assert sinks.write_csv(df, path, skip_empty=True) == 0
    assert not os.path.exists(path)


def test_table_sink_roundtrip(spark):
    r = enroll(spark, SF001)
    path = os.path.join(tempfile.mkdtemp(prefix="paritas-tbl-"), "t")
    df = r.count_differences
    df.write.mode("overwrite").option("path", path).saveAsTable("paritas_test_cd")
    assert spark.table("paritas_test_cd").exceptAll(df).count() == 0


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() == 1376
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("sf_dir", [SF001])
def test_every_query_matches_its_oracle(spark, sf_dir):
    import __spark_entry__ as E
    from oracle_check import compare, duck

    con = duck(sf_dir)
    bad = []
    for key, fn in sorted(E.queries().items()):
        r = compare(spark, con, key, fn, E.oracle_sql().get(key), sf_dir)
        if r.get("oracle", 1) is not None and not r.get("values"):
            bad.append(r)
    assert not bad, bad


def test_sources_by_sql_args_and_format(spark):
    from paritas.sources import as_dataframe

    path = f"{SF001}/region.parquet"
    by_format = as_dataframe(spark, {"format": "parquet", "path": path})
    by_path = as_dataframe(spark, path)
    assert by_format.count() == by_path.count() == 5
    by_path.createOrReplaceTempView("paritas_region")
    picked = as_dataframe(spark, ("SELECT r_name FROM paritas_region WHERE r_regionkey = :k",
                                  {"k": 2}))
    assert [r.r_name for r in picked.collect()] == [
        r.r_name for r in by_path.filter("r_regionkey = 2").collect()]
