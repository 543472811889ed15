"""Digest tree, catalog metadata, previews by file."""

from conftest import SF001
from test_hot_keys import _plan_nodes

from paritas import ReconSpec
from paritas.operators import diff, profile, structure
from paritas.plans.run import run_generic
from paritas.sources import preview_files, read_table


def _sides(spark, differ):
    left = read_table(spark, SF001, "orders")
    right = left.selectExpr("o_orderkey", f"if({differ}, o_custkey + 1, o_custkey) "
                            "AS o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    spec = ReconSpec(keys=("o_orderkey",))
    return left, right, spec.resolve(left, right)


def test_equal_sides_give_no_ranges(spark):
    left, right, rs = _sides(spark, "o_orderkey < 0")
    assert diff.differing_ranges(left, right, rs).count() == 0
    assert diff.fingerprint_diff(left, right, rs).count() == 0
    # what is shuffled for the digests does not depend on the compared columns
    nodes = _plan_nodes(diff.differing_ranges(left, right, rs))
    shuffles = [n for n in nodes if n["class"].endswith("ShuffleExchangeExec")]
    assert shuffles and not any("o_" in str(n.get("outputPartitioning")) for n in shuffles)
    digested = diff.differing_ranges(left, right, rs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in digested


def test_only_ranges_that_differ_are_paired(spark):
    left, right, rs = _sides(spark, "o_orderkey % 50 = 0")
    want = sorted(r[0] for r in left.filter("o_orderkey % 50 = 0").select("o_orderkey").collect())
    assert sorted(r[0] for r in diff.fingerprint_diff(left, right, rs).collect()) == want
    ranges = diff.differing_ranges(left, right, rs)
    paired = diff._in_ranges(left.select(*rs.common), right.select(*rs.common), rs, ranges)
    assert len(want) <= paired.count() <= len(want) + 5


def test_duplicates_and_one_sided_rows(spark):
    schema = "k long, v string, w string"
    left = spark.createDataFrame([(1, "a", None), (1, "b", "x"), (2, None, "c"), (3, "d", "d"),
                                  (None, "e", "e"), (5, "f", "f")], schema)
    right = spark.createDataFrame([(1, "b", "x"), (1, "a", None), (2, "c", None), (3, "d", "d"),
                                   (None, "z", "e"), (6, "f", "f")], schema)
    rs = ReconSpec(keys=("k",)).resolve(left, right)
    assert [r[0] for r in diff.fingerprint_diff(left, right, rs).collect()] == [2]


def test_catalog_profile_and_keys(spark, tmp_path):
    for name, n in (("one", 10), ("two", 20)):
        spark.sql(f"CREATE TABLE paritas_cat_{name} (id BIGINT, part STRING, name VARCHAR({n}) DEFAULT "
                  f"'none') USING parquet LOCATION '{tmp_path / name}' TBLPROPERTIES "
                  "('primary_key' = 'id, part')")
        spark.sql(f"INSERT INTO paritas_cat_{name} VALUES (1, 'a', 'x'), (1, 'b', 'y')")
    try:
        rows = {r.column_name: r for r in profile.catalog_profile(spark, "paritas_cat_one").collect()}
        assert rows["name"].type == "varchar(10)" and rows["name"].default_value == "'none'"
        assert [c for c, r in rows.items() if r.is_key] == ["id", "part"]
        found = structure.structure_diff(spark, spark.table("paritas_cat_one"),
                                         spark.table("paritas_cat_two")).collect()
        assert [(r.type, r.table1_value, r.table2_value) for r in found] == [
            ("column_type_mismatch", "varchar(10)", "varchar(20)")]
        res = run_generic(spark, "paritas_cat_one", "paritas_cat_two", output=str(tmp_path / "out"))
        summary = spark.read.option("header", True).csv(res.written["csv:summary"]).first()
        assert summary.key_columns == "id, part" and res.figures["mismatched_rows"] == 0
    finally:
        for name in ("one", "two"):
            spark.sql(f"DROP TABLE paritas_cat_{name}")


def test_preview_reads_the_first_files_only(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(1000).selectExpr("id", "id % 2 AS half").repartition(10).write.partitionBy(
        "half").parquet(path)
    files = sorted(spark.read.parquet(path).inputFiles())
    got = preview_files(spark, path, 120)
    assert got.columns == ["id", "half"] and got.count() == 120
    want = [r.id for f in files[:3] for r in spark.read.parquet(f).collect()][:120]
    assert [r.id for r in got.collect()] == want and {r.half for r in got.collect()} == {0}
    read = [n for n in _plan_nodes(got) if n["class"].endswith("FileSourceScanExec")]
    assert len(read) == 1
    inner = got._jdf.queryExecution().optimizedPlan().collectLeaves().head().relation()
    assert inner.location().inputFiles().__len__() <= 3
    assert preview_files(spark, path, 5000).count() == 1000
