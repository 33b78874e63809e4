"""ETL: incremental bookmark, null-field drop, mapping, schema drift."""

from pyspark.sql import functions as F

from quarry.operators import etl
from quarry.session import scratch_path
from quarry.sources import files
from quarry.streaming.incremental import run_incremental
from quarry.tables import Tables


def test_incremental_reads_only_new_files(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    root = scratch_path(spark, "t-incr")
    landing, sink, ckpt = f"{root}/in", f"{root}/out", f"{root}/ckpt"
    first, second = ev.where("event_id % 2 = 0"), ev.where("event_id % 2 = 1")
    n1, n2 = first.count(), second.count()
    files.write(first, landing)
    assert run_incremental(spark, landing, sink, ckpt, ev.schema) == n1
    assert run_incremental(spark, landing, sink, ckpt, ev.schema) == 0
    files.write(second, landing, mode="append")
    assert run_incremental(spark, landing, sink, ckpt, ev.schema) == n2
    assert files.read(spark, sink).count() == n1 + n2


def test_drop_null_fields_and_mapping(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.withColumn("empty", F.lit(None).cast("string"))
    assert "empty" not in etl.drop_null_fields(o).columns
    m = etl.apply_mapping(o, [("o_orderkey", "bigint", "id", "bigint"), ("o_totalprice", "double", "v", "decimal(18,2)")])
    assert m.columns == ["id", "v"] and dict(m.dtypes)["v"] == "decimal(18,2)"


def test_schema_drift_statuses(spark):
    df = spark.createDataFrame(
        [('{"a": 1, "b": "x"}',), ('{"a": 2, "c": 1.5}',), ('{"a": 3, "c": 2, "d": true}',)], "j string"
    )
    found = etl.infer_json_fields(df, "j")
    got = {r.field: r.inferred_type for r in found.collect()}
    assert got == {"a": "bigint", "b": "string", "c": "double", "d": "boolean"}
    drift = etl.schema_drift(found, etl.previous_schema(spark, [("a", "string"), ("b", "string"), ("z", "bigint")]))
    status = {r.field: r.change for r in drift.collect()}
    assert status == {"a": "changed", "b": "unchanged", "c": "added", "d": "added", "z": "removed"}


def test_glob_filter_skips_temp_files(spark, sf_dir):
    path = files.write(Tables(spark, sf_dir).region, scratch_path(spark, "t-glob"))
    spark.createDataFrame([("junk",)], "x string").write.mode("append").text(path)  # text files, not *.parquet
    assert etl.read_data_files(spark, path).count() == 5


def test_mapping_checks_the_declared_types(spark, sf_dir):
    import pytest

    o = Tables(spark, sf_dir).orders
    with pytest.raises(ValueError, match="source types"):
        etl.apply_mapping(o, [("o_orderkey", "string", "id", "bigint")])
    with pytest.raises(ValueError, match="source types"):
        etl.apply_mapping(o, [("no_such", "string", "id", "bigint")])


def test_incremental_counts_beyond_the_progress_reports(spark):
    """More micro-batches than the progress reports that Spark keeps."""
    root = scratch_path(spark, "t-many-batches")
    files.write(spark.range(60).repartition(6), f"{root}/in")
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    try:
        schema = spark.range(0).schema
        n = run_incremental(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt", schema, max_files_per_trigger=1)
    finally:
        spark.conf.set(key, before)
    assert n == 60


def test_discovery_over_files_logs_removals(spark, sf_dir, caplog):
    path = scratch_path(spark, "t-discover")
    files.write(spark.range(3), path)
    spark.createDataFrame([("junk",)], "x string").write.mode("append").text(path)
    with caplog.at_level("WARNING"):
        got = {r.field: r.change for r in etl.discover_files(spark, path, [("id", "bigint"), ("gone", "string")]).collect()}
    assert got == {"id": "unchanged", "gone": "removed"}
    assert "gone" in caplog.text


def test_a_failed_run_is_redone(spark, tmp_path):
    """A run dies after some micro-batches; the next one redoes the rest, each row once, and counts what it completed."""
    import pytest

    root = scratch_path(spark, "t-failed")
    files.write(spark.range(60).repartition(6), f"{root}/in")
    schema = spark.range(0).schema
    args = (spark, f"{root}/in", f"{root}/out", f"{root}/ckpt", schema)
    seen = files.read(spark, f"{root}/in").where("id = 33").select(F.input_file_name()).first()[0]
    bad = F.when(F.input_file_name() == seen, F.raise_error(F.lit("broken file")).cast("bigint")).otherwise(F.col("id"))
    with pytest.raises(Exception, match="broken file"):
        run_incremental(*args, transform=lambda df: df.select(bad.alias("id")), max_files_per_trigger=1)
    done = files.read(spark, f"{root}/out").count() if list_parquet(spark, f"{root}/out") else 0
    assert done < 60
    assert run_incremental(*args, max_files_per_trigger=1) == 60 - done
    assert sorted(r.id for r in files.read(spark, f"{root}/out").collect()) == list(range(60))
    assert run_incremental(*args) == 0


def list_parquet(spark, path):
    from pyspark.errors import AnalysisException

    try:
        return files.read(spark, path).inputFiles()
    except AnalysisException:
        return []


def test_rows_counted_behind_a_filter(spark):
    root = scratch_path(spark, "t-filtered")
    files.write(spark.range(50), f"{root}/in")
    n = run_incremental(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt", spark.range(0).schema, transform=lambda df: df.where("id % 5 = 0"))
    assert n == 10 == files.read(spark, f"{root}/out").count()


NESTED = [
    '{"a": 1, "b": {"c": "x", "d": [1, 2.5]}, "e": [{"f": true}, {"g": null}], "odd name.x": 1}',
    '{"a": 2, "b": {"c": null}, "e": [], "m": 1, "n": 123456789012345678901}',
    '{"a": 3000000000, "b": null, "e": [{"f": false, "g": {"h": [["x"], []]}}], "m": {"z": 1}, "n": 0.5}',
    "[1]", "not json", None, "{}", '{"OBJECT<": {"p": [1]}}',
]


def test_nested_schema_reads_every_row_back(spark):
    from quarry.operators import nested

    df = spark.createDataFrame([(k, j) for k, j in enumerate(NESTED)], "id int, j string")
    schema = nested.infer_json_schema(df, "j")
    got = {r.id: r.value.asDict(recursive=True) for r in nested.read_json(df, "j", schema).collect() if r.value is not None and r.id not in (3, 4)}
    assert got[0]["a"] == 1 and got[0]["b"] == {"c": "x", "d": [1.0, 2.5]} and got[0]["e"][0]["f"] is True and got[0]["odd name.x"] == 1
    assert got[1]["m"] == "1" and got[2]["m"] == '{"z":1}' and got[2]["a"] == 3_000_000_000
    assert got[2]["e"][0]["g"]["h"] == [["x"], []] and got[7]["OBJECT<"] == {"p": [1]}
    kinds = {r.field: (r.inferred_type, r["values"]) for r in nested.discover_json(df, "j").collect()}
    assert kinds["a"] == ("bigint", 3) and kinds["b"] == ("struct", 2) and kinds["b.c"] == ("string", 1) and kinds["b.d[]"] == ("double", 2)
    assert kinds["e"] == ("array", 3) and kinds["e[]"] == ("struct", 3) and kinds["e[].f"] == ("boolean", 2) and kinds["e[].g.h[][]"] == ("string", 1)
    assert kinds["m"] == ("string", 2) and kinds["n"][0].startswith("decimal") and kinds["n"][1] == 2


def test_nested_discovery_without_objects(spark):
    from quarry.operators import nested

    df = spark.createDataFrame([("[1]",), (None,), ("x",)], "j string")
    assert nested.infer_json_schema(df, "j").fields == [] and nested.discover_json(df, "j").count() == 0


def test_losses_at_null_keys(spark, sf_dir, monkeypatch):
    """Rows with a NULL time, balance or status come through the queries that split by them."""
    from quarry.plans import etl as plans
    from quarry.plans import io as plans_io

    t = Tables(spark, sf_dir)

    class Odd:
        def __init__(self, *_):
            self.events = spark.createDataFrame(t.events.limit(9).withColumn("ts", F.when(F.col("event_id") % 2 == 0, F.col("ts"))).collect(), t.events.schema)
            self.customer = spark.createDataFrame(t.customer.limit(9).withColumn("c_acctbal", F.when(F.col("c_custkey") % 2 == 0, F.col("c_acctbal"))).collect(), t.customer.schema)
            self.orders = spark.createDataFrame(t.orders.limit(9).withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus"))).collect(), t.orders.schema)

    monkeypatch.setattr(plans, "Tables", Odd)
    monkeypatch.setattr(plans_io, "Tables", Odd)
    assert plans.etl_incremental(spark, sf_dir).count() == 9
    got = {r.field: r["values"] for r in plans.etl_schema_discovery_files(spark, sf_dir).collect()}
    assert got["c_custkey"] == got["c_name"] == 9
    assert plans_io.scan_merge_schema(spark, sf_dir).count() == 9
