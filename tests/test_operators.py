import os
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from coldshelf import Granularity, TableSpec, Window
from coldshelf.functions.columns import boolean_from_text, safe_key
from coldshelf.operators import delete, export, reconcile, restore
from coldshelf.session import scratch_dir
from coldshelf.sources import scan
from coldshelf.sources.archive import ArchiveSchemaError, archive_scan
from coldshelf.spec import archive_schema

ALL_TYPES = (
    "id bigint, fye date, tiny tinyint, small smallint, whole int, amount decimal(12,2), label string, "
    "active boolean, closed_at timestamp_ntz, ratio double, share float, raw binary"
)


def typed_rows(spark):
    moment = datetime(2017, 3, 16, 21, 5, 7, 123457)
    nan, zero = float("nan"), -0.0
    return spark.createDataFrame(
        [
            (7101, date(2017, 3, 15), 1, 2, 3, Decimal("907.18"), "first half", True, moment, nan, 0.5, b"\x00\xff"),
            (7102, date(2017, 3, 16)) + (None,) * 10,
            (7103, date(2017, 4, 1), -1, -2, -3, Decimal("-0.01"), "", False, moment, zero, nan, b""),
        ],
        ALL_TYPES,
    )


def verdicts(source, archive, pk=("id",)):
    found = reconcile.diff(source, archive, pk).collect()
    return {r.id: (r.verdict, r.mismatch_columns) for r in found}


def pairs(spark, rows):
    return spark.createDataFrame(rows, "id bigint, a string, b timestamp_ntz")


T0 = datetime(2020, 1, 1, 0, 0, 0, 1)
T1 = datetime(2020, 1, 1, 0, 0, 0, 2)


# -- scans -------------------------------------------------------------------


def test_null_dates_are_in_no_window(spark):
    rows = spark.createDataFrame([(1, None), (2, date(2020, 1, 1)), (3, date(2020, 2, 1))], "id int, fye date")
    window = Window(date(2020, 1, 1), date(2020, 2, 1))
    assert [r.id for r in scan.window_scan(rows, TableSpec("t"), window).collect()] == [2]


def test_predicate_is_kept_together(spark):
    rows = spark.range(10).withColumn("fye", F.lit(date(2019, 1, 1)))
    spec = TableSpec("t", predicate="id = 1 OR id = 2")
    assert scan.window_scan(rows, spec, Window(date(2020, 1, 1), date(2020, 2, 1))).count() == 0


def test_window_filter_reaches_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    spec = TableSpec("orders", pk="o_orderkey", date_col="o_orderdate")
    rows = scan.window_count(orders, spec, Window(date(1995, 1, 1), date(1995, 5, 1)))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in plan


def test_date_column_must_be_a_date(spark):
    with pytest.raises(TypeError, match="not a date"):
        scan.window_scan(spark.range(1), TableSpec("t", date_col="id"), Window(date(2020, 1, 1), date(2020, 2, 1)))


def test_types_outside_the_archive_are_refused(spark):
    embeddings = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    with pytest.raises(TypeError, match="column 'embedding'"):
        archive_schema(embeddings.schema)
    with pytest.raises(ValueError, match="no columns"):
        archive_schema(T.StructType([]))


def test_small_integers_are_widened(spark):
    stored = archive_schema(typed_rows(spark).schema)
    assert [stored[c].dataType for c in ("tiny", "small", "whole")] == [T.IntegerType()] * 3
    assert stored["amount"].dataType == T.DecimalType(12, 2)


def test_schema_discovery_lists_columns_in_order(spark):
    found = scan.schema_discovery(typed_rows(spark), required=("id",), count_nulls=True).orderBy("ordinal").collect()
    assert [r.column_name for r in found] == typed_rows(spark).columns
    assert [r.archive_type for r in found] == (
        "LONG DATE INT INT INT DECIMAL STRING BOOLEAN TIMESTAMP DOUBLE FLOAT BYTES".split()
    )
    assert (found[0].nullable, found[0].null_rows) == (False, 0)
    assert (found[5].num_precision, found[5].num_scale, found[5].null_rows) == (12, 2, 1)
    assert "null_rows" not in scan.schema_discovery(typed_rows(spark)).columns


def scans(frame):
    """Scan nodes of a table's files in the initial plan."""
    plan = frame._jdf.queryExecution().sparkPlan().toString()
    return plan.count("FileScan parquet")


def test_plans_read_a_table_once(spark):
    from coldshelf.queries import QUERIES

    found = {n: scans(QUERIES[n](spark, "/root/testdata/sf0.001")) for n in ("window_plan_counts", "reconcile_duplicates")}
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    assert found["window_plan_counts"] == 1 and found["reconcile_duplicates"] <= 5
    assert scans(scan.schema_discovery(orders)) == 0


def test_projection_rescales_half_up_and_refuses_overflow(spark):
    rows = spark.sql("select 1.005bd as d union all select -1.005bd")
    target = T.StructType.fromDDL("d decimal(4,2)")
    assert sorted(r.d for r in scan.typed_projection(rows, target).collect()) == [Decimal("-1.01"), Decimal("1.01")]
    too_big = spark.sql("select 123.4bd as d, 300 as n")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            for ddl in ("d decimal(4,2)", "n tinyint"):
                with pytest.raises(Exception, match="does not fit"):
                    scan.typed_projection(too_big, T.StructType.fromDDL(ddl)).collect()
        finally:
            spark.conf.set("spark.sql.ansi.enabled", "true")


def test_booleans_from_text(spark):
    rows = spark.createDataFrame([("TRUE",), ("true",), ("yes",), ("1",), (None,)], "t string")
    assert [r.b for r in rows.select(boolean_from_text(F.col("t")).alias("b")).collect()] == [
        True, True, False, False, None,
    ]


def test_null_violations_name_every_column(spark):
    found = scan.null_violations(typed_rows(spark), ("id", "label", "raw")).collect()
    assert {r.column_name: r.null_rows for r in found} == {"id": 0, "label": 1, "raw": 1}


def test_safe_key(spark):
    row = spark.sql("select '2015/01 a-b_c' as k")
    assert row.select(safe_key(F.col("k")).alias("k")).first().k == "2015_01_a-b_c"


# -- export ------------------------------------------------------------------


@pytest.mark.parametrize(
    "granularity, keys",
    [
        (Granularity.EXACT_DATE, {"2017-03-15", "2017-03-16", "2017-04-01"}),
        (Granularity.MONTH, {"2017-03", "2017-04"}),
        (Granularity.YEAR, {"2017"}),
        (Granularity.NONE, {"all"}),
    ],
)
def test_every_type_survives_every_granularity(spark, granularity, keys):
    spec = TableSpec("round_trip", granularity=granularity)
    stored = export.archive_rows(typed_rows(spark), spec)
    path = scratch_dir(spark, "types")
    assert export.write_archive(stored, spec, path).rows == 3
    archive = export.read_archive(spark, path, stored.schema)
    assert {r.archive_key for r in archive.select("archive_key").collect()} == keys
    result = verdicts(stored, archive.drop("archive_key"))
    assert list(result.values()) == [("match", [])] * 3
    row = reconcile.set_equality(stored, archive.drop("archive_key")).first()
    assert (row.only_left, row.only_right) == (0, 0)


def test_rows_without_a_date_get_their_own_key(spark):
    rows = spark.createDataFrame([(1, None), (2, date(2020, 1, 1))], "id int, fye date")
    found = export.rows_per_key(rows, TableSpec("t")).collect()
    assert {r.archive_key: r.n_rows for r in found} == {"unknown": 1, "2020-01": 1}


def test_part_files_roll_over_and_are_sorted_by_key(spark):
    rows = spark.range(100, numPartitions=8).select(
        (99 - F.col("id")).alias("id"), F.lit(date(2020, 1, 1)).alias("fye")
    )
    spec = TableSpec("_odd name", max_rows_per_file=30)
    path = scratch_dir(spark, "roll")
    stem = export.file_stem(spec, "tok/1", datetime(2026, 1, 1, 9, 0))
    export.write_archive(rows, spec, path, stem)
    archive = export.read_archive(spark, path, rows.schema)
    files = export.manifest(archive, path).orderBy("base_name").collect()
    assert [r.n_rows for r in files] == [30, 30, 30, 10]
    assert all(r.base_name.startswith("t_odd_name_run-20260101T090000_token-tok_1-") for r in files)
    for r in files:
        ids = [x.id for x in spark.read.parquet(r.file_path).collect()]
        assert ids == sorted(ids)


def test_capped_files_are_written_without_one_more_file_for_each(spark):
    rows = spark.range(200).withColumn("fye", F.lit(date(2020, 1, 1)))
    path = scratch_dir(spark, "capped")
    stats = export.write_archive(rows, TableSpec("t", max_rows_per_file=10), path)
    names = [f.name for f in Path(path.removeprefix("file:")).rglob("*") if "part-" in f.name]
    assert stats.rows == 200 and len(names) == 20 and all(n.endswith(".parquet") for n in names)
    assert sorted(r.id for r in export.read_archive(spark, path, rows.schema).collect()) == list(range(200))


def test_an_existing_export_is_never_overwritten(spark):
    rows = spark.range(3).withColumn("fye", F.lit(date(2020, 1, 1)))
    path = scratch_dir(spark, "once")
    export.write_archive(rows, TableSpec("t"), path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        export.write_archive(rows, TableSpec("t"), path)


def test_a_large_key_is_written_by_several_tasks(spark):
    rows = spark.range(200_000, numPartitions=8).select(
        "id", F.when(F.col("id") % 3 == 0, date(2020, 1, 1)).otherwise(date(2020, 2, 1)).alias("fye"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    path = scratch_dir(spark, "skew")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        assert export.write_archive(rows, TableSpec("t"), path).rows == 200_000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = export.manifest(export.read_archive(spark, path, rows.schema), path)
    per_key = {r.archive_key: r.n for r in files.groupBy("archive_key").agg(F.count("*").alias("n")).collect()}
    assert per_key["2020-02"] > 3
    assert files.agg(F.sum("n_rows")).first()[0] == 200_000


def test_a_key_is_spread_without_adaptive_execution(spark):
    rows = spark.range(20_000, numPartitions=4).withColumn("fye", F.lit(date(2020, 1, 1)))
    path = scratch_dir(spark, "static")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        assert export.write_archive(rows, TableSpec("t"), path).rows == 20_000
        files = export.manifest(export.read_archive(spark, path, rows.schema), path).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert len(files) > 4 and sum(r.n_rows for r in files) == 20_000


# -- archive scan -------------------------------------------------------------


def export_files(spark, rows, spec=TableSpec("t")):
    path = scratch_dir(spark, "scan")
    export.write_archive(rows, spec, path)
    archive = export.read_archive(spark, path, rows.schema)
    return [r.file_path for r in export.manifest(archive, path).collect()]


def test_named_files_are_checked_one_by_one(spark):
    good = spark.range(3).withColumn("fye", F.lit(date(2020, 1, 1)))
    fewer, retyped = good.select("fye"), good.withColumn("id", F.col("id").cast("int"))
    files = export_files(spark, good)
    assert archive_scan(spark, files, good.schema).count() == 3
    for other in (fewer, retyped):
        with pytest.raises(ArchiveSchemaError, match="expected struct<id:bigint,fye:date>, found"):
            archive_scan(spark, files + export_files(spark, other, TableSpec("t", pk="fye")), good.schema)
    with pytest.raises(ArchiveSchemaError, match="does not exist"):
        archive_scan(spark, files + [files[0] + ".gone"], good.schema)
    with pytest.raises(ValueError, match="no archive file"):
        archive_scan(spark, [], good.schema)


def test_a_broken_file_is_refused(spark, tmp_path):
    broken = tmp_path / "part.parquet"
    broken.write_bytes(os.urandom(64))
    with pytest.raises(ArchiveSchemaError, match="not a readable Parquet file"):
        archive_scan(spark, [str(broken)], T.StructType.fromDDL("id bigint"))


# -- reconcile -----------------------------------------------------------------


def test_every_fault_gets_its_verdict(spark):
    source = pairs(spark, [(1, "x", T0), (2, "x", T0), (3, None, T0), (4, "x", None), (5, "x", T0), (None, "n", T0)])
    archive = pairs(spark, [(1, "x", T0), (2, "y", T1), (3, "x", T0), (4, "x", T0), (6, "x", T0), (None, "n", T0)])
    assert verdicts(source, archive) == {
        1: ("match", []),
        2: ("mismatch", ["a", "b"]),
        3: ("mismatch", ["a"]),
        4: ("mismatch", ["b"]),
        5: ("missing_in_archive", []),
        6: ("missing_in_source", []),
        None: ("match", []),
    }


def test_one_microsecond_is_a_mismatch(spark):
    assert verdicts(pairs(spark, [(1, "x", T0)]), pairs(spark, [(1, "x", T1)])) == {1: ("mismatch", ["b"])}


def test_repeated_keys_are_reported_once(spark):
    source = pairs(spark, [(1, "x", T0), (1, "y", T0), (2, "x", T0), (None, "n", T0), (None, "n", T0)])
    archive = pairs(spark, [(1, "x", T0), (2, "x", T1), (3, "z", T0), (3, "z", T0)])
    assert verdicts(source, archive) == {
        1: ("duplicate_key", []),
        2: ("mismatch", ["b"]),
        3: ("duplicate_key", []),
        None: ("duplicate_key", []),
    }


def test_a_key_with_a_third_of_all_rows(spark):
    many = spark.range(60_000).select(
        F.when(F.col("id") < 20_000, F.lit(-1)).otherwise(F.col("id")).alias("id"), F.lit("x").alias("a")
    )
    summary = reconcile.summarize(reconcile.diff(many, many, ("id",))).collect()
    assert {r.verdict: r.n_keys for r in summary} == {"duplicate_key": 1, "match": 40_000}
    assert reconcile.duplicate_keys(many, ("id",)).collect()[0].copies == 20_000
    targets = delete.delete_targets(many, many.where("id < 30000"), ("id",))
    assert targets.count() == 30_000 and targets.where("id = -1").count() == 20_000
    dated = many.withColumn("fye", F.lit(date(2020, 1, 1)))
    year = Window(date(2020, 1, 1), date(2021, 1, 1))
    assert delete.survivors(dated, many.where("id < 30000"), TableSpec("t"), year).count() == 30_000
    assert delete.survivors(dated, many.where("id > 30000"), TableSpec("t"), year).where("id = -1").count() == 20_000


def test_different_columns_are_refused(spark):
    with pytest.raises(ValueError, match="column mismatch"):
        reconcile.diff(spark.range(1), spark.range(1).selectExpr("cast(id as int) id"), ("id",))


def test_count_gates(spark):
    source = pairs(spark, [(1, "x", T0), (2, "x", T0)])
    archive = pairs(spark, [(1, "x", T0), (1, "x", T0), (3, "x", T0)])
    row = reconcile.count_gates(source, archive, ("id",), F.lit(2)).first()
    assert row.asDict() == dict(
        source_rows=2, archive_rows=3, duplicate_keys=1, missing_in_archive=1, missing_in_source=1,
        archive_holds_export=False, source_unchanged=True, keys_unique=False, keys_equal=False,
    )
    empty = pairs(spark, [])
    assert reconcile.key_profile(empty, empty, ("id",)).source_rows == 0


def test_missing_rows_of_both_sides_with_null_keys(spark):
    source = pairs(spark, [(1, "x", T0), (None, "n", T0)])
    archive = pairs(spark, [(None, "n", T0), (2, "x", T0), (2, "x", T0)])
    assert [r.id for r in reconcile.missing_in_archive(source, archive, ("id",)).collect()] == [1]
    assert [r.id for r in reconcile.missing_in_source(source, archive, ("id",)).collect()] == [2, 2]


def test_set_equality_counts_multisets(spark):
    left, right = pairs(spark, [(1, "x", T0)] * 3 + [(2, None, None)]), pairs(spark, [(1, "x", T0), (2, None, None)] * 1)
    row = reconcile.set_equality(left, right).first()
    assert (row.only_left, row.only_right) == (2, 0)


def test_content_join_needs_no_cross_product(spark):
    source = spark.range(10).withColumn("a", F.lit("x"))
    plan = reconcile.diff(source, source, ("id",))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


# -- delete --------------------------------------------------------------------


def test_null_keys_are_never_deleted(spark):
    rows = pairs(spark, [(1, "x", T0), (None, "n", T0), (None, "n", T0)])
    archived = pairs(spark, [(None, "n", T0), (1, "x", T0)])
    assert delete.delete_targets(rows, archived, ("id",)).count() == 1
    year = Window(T0.date().replace(month=1, day=1), T0.date().replace(month=12, day=31))
    spec = TableSpec("t", pk="id", date_col=rows.columns[-1])
    assert delete.survivors(rows, archived, spec, year).count() == 2


def test_membership_runs_no_job_and_moves_no_row_outside_the_window(spark):
    rows = spark.range(1000).select("id", F.date_add(F.lit(date(2020, 1, 1)), F.col("id").cast("int")).alias("fye"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "no job may run")
    kept = delete.survivors(rows, rows, TableSpec("t"), Window(date(2020, 1, 1), date(2020, 2, 1)))
    assert not tracker.getJobIdsForGroup("building")
    spark.sparkContext.setJobGroup("", "")
    assert kept.count() == 1000 - 31


def test_batches_cover_the_window_without_overlap(spark):
    rows = spark.range(10_000, numPartitions=8).select("id", F.lit(date(2020, 1, 1)).alias("fye"))
    window = Window(date(2020, 1, 1), date(2020, 2, 1))
    plan = delete.delete_batch_plan(rows, TableSpec("t"), window, 300).orderBy("first_pk").collect()
    assert sum(r.n_rows for r in plan) == 10_000 and max(r.n_rows for r in plan) <= 300
    assert all(a.last_pk + 1 == b.first_pk for a, b in zip(plan, plan[1:]))
    assert all(r.n_rows == r.last_pk - r.first_pk + 1 for r in plan)


# -- restore -------------------------------------------------------------------


def test_restore_union_checks_columns(spark):
    current = spark.range(2).withColumn("note", F.lit("x"))
    back = spark.range(2, 4)
    with pytest.raises(ValueError, match="lacks column"):
        restore.restore_union(current, back)
    filled = restore.restore_union(current, back, allow_missing_columns=True)
    assert sorted(tuple(r) for r in filled.collect()) == [(0, "x"), (1, "x"), (2, None), (3, None)]
    with pytest.raises(ValueError, match="no longer has"):
        restore.restore_union(back, current, allow_missing_columns=True)
    with pytest.raises(ValueError, match="types differ"):
        restore.restore_union(back, back.selectExpr("cast(id as int) id"))
