"""Sources and sinks: inline and generated rows, file scans of every format,
and writes (codecs, partitioning, file counts, save modes, tables).

Each sink query writes into a fresh folder below the shared checkpoint
folder and reads the result back, so the round trip is what gets compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from quarry.plans.registry import query
from quarry.session import scratch_path
from quarry.sources import files
from quarry.sources.synthetic import synthetic_staff
from quarry.tables import Tables


def _t(spark, sf_dir) -> Tables:
    return Tables(spark, sf_dir)


# Shared write-once inputs for the scan queries, one per (application, sf, layout).
_WRITTEN: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, layout: str, build) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, layout)
    if key not in _WRITTEN:
        _WRITTEN[key] = build(scratch_path(spark, layout))
    return _WRITTEN[key]


def orders_with_year_month(orders: DataFrame) -> DataFrame:
    return orders.withColumn("o_year", F.year("o_orderdate")).withColumn("o_month", F.month("o_orderdate"))


def partitioned_orders(spark: SparkSession, sf_dir: str) -> str:
    """``orders`` written once as an ``o_year=/o_month=`` tree."""

    def build(path):
        df = orders_with_year_month(_t(spark, sf_dir).orders)
        return files.write_clustered(df, path, ["o_year", "o_month"], mode="overwrite")

    return _once(spark, sf_dir, "orders-by-month", build)


SQL_ORDERS_YM = (
    "*, CAST(year(o_orderdate) AS INTEGER) AS o_year, CAST(month(o_orderdate) AS INTEGER) AS o_month"
)

# ------------------------------------------------------------------ 2.1 sources

# The market segments of the test data and their labels.
SEGMENT_ROWS = [
    (1, "AUTOMOBILE", "vehicles"),
    (2, "BUILDING", "construction"),
    (3, "FURNITURE", "home"),
    (4, "HOUSEHOLD", "home"),
    (5, "MACHINERY", "industry"),
]

SQL_SEGMENTS = """(VALUES (1, 'AUTOMOBILE', 'vehicles'), (2, 'BUILDING', 'construction'),
  (3, 'FURNITURE', 'home'), (4, 'HOUSEHOLD', 'home'), (5, 'MACHINERY', 'industry'))
  AS s(segment_id, segment, label)"""


@query(
    "src_inline_rows",
    oracle=f"""
SELECT c.c_custkey, CAST(s.segment_id AS BIGINT) AS segment_id, s.label
FROM customer c JOIN {SQL_SEGMENTS} ON c.c_mktsegment = s.segment""",
)
def src_inline_rows(spark, sf_dir):
    """Rows from Python tuples with names only: ints are inferred as bigint."""
    seg = spark.createDataFrame(SEGMENT_ROWS, ["segment_id", "segment", "label"])
    c = _t(spark, sf_dir).customer
    out = c.join(seg, F.col("c_mktsegment") == F.col("segment"))
    return out.select("c_custkey", "segment_id", "label")


SEGMENT_SCHEMA = StructType(
    [
        StructField("segment_id", IntegerType(), nullable=False),
        StructField("segment", StringType(), nullable=True),
        StructField("label", StringType(), nullable=True),
    ]
)


@query(
    "src_explicit_schema",
    oracle=f"""
SELECT c.c_custkey, CAST(s.segment_id AS INTEGER) AS segment_id, s.label
FROM customer c JOIN {SQL_SEGMENTS} ON c.c_mktsegment = s.segment""",
)
def src_explicit_schema(spark, sf_dir):
    """Same rows with a StructType: ``segment_id`` is a non-null int."""
    seg = spark.createDataFrame(SEGMENT_ROWS, SEGMENT_SCHEMA)
    c = _t(spark, sf_dir).customer
    out = c.join(seg, F.col("c_mktsegment") == F.col("segment"))
    return out.select("c_custkey", "segment_id", "label")


_M = 2147483647  # 2^31 - 1
_A = 48271


def _sql_minstd(seed: int) -> str:
    r1 = f"((c_custkey * {_A} + {seed}) % {_M})"
    r2 = f"(({r1} * {_A}) % {_M})"
    r3 = f"(({r2} * {_A}) % {_M})"
    r4 = f"(({r3} * {_A}) % {_M})"
    return r1, r2, r3, r4


def _synthetic_oracle(seed: int = 42) -> str:
    r1, r2, r3, r4 = _sql_minstd(seed)
    return f"""
SELECT c_custkey AS id, 'staff_' || CAST(c_custkey AS VARCHAR) AS name,
       (['sales','engineering','finance','people','operations'])[CAST({r1} % 5 AS INTEGER) + 1] AS department,
       (['north','south','east','west','central'])[CAST({r2} % 5 AS INTEGER) + 1] AS city,
       CAST(300000 + {r3} % 1200001 AS DOUBLE) / 100 AS salary,
       DATE '2022-01-01' + CAST({r4} % 731 AS INTEGER) AS hired
FROM customer"""


@query("src_synthetic_rows", oracle=_synthetic_oracle())
def src_synthetic_rows(spark, sf_dir):
    """A seeded synthetic staff table, one row per customer key (distributed)."""
    ids = _t(spark, sf_dir).customer.select(F.col("c_custkey").alias("id"))
    return synthetic_staff(ids, seed=42)


@query("scan_parquet", oracle="SELECT * FROM orders")
def scan_parquet(spark, sf_dir):
    return files.read(spark, f"{sf_dir}/orders.parquet")


@query("scan_partitioned", oracle=f"SELECT {SQL_ORDERS_YM} FROM orders")
def scan_partitioned(spark, sf_dir):
    root = partitioned_orders(spark, sf_dir)
    return files.read_partitioned(spark, root)


@query(
    "scan_glob",
    oracle=f"SELECT {SQL_ORDERS_YM} FROM orders WHERE year(o_orderdate) = 1996",
)
def scan_glob(spark, sf_dir):
    root = partitioned_orders(spark, sf_dir)
    return files.read_partitioned(spark, f"{root}/o_year=1996/o_month=*", base_path=root)


def partitioned_customer(spark: SparkSession, sf_dir: str) -> str:
    def build(path):
        c = _t(spark, sf_dir).customer
        return files.write_clustered(c, path, ["c_mktsegment"], mode="overwrite")

    return _once(spark, sf_dir, "customer-by-segment", build)


@query(
    "scan_multi_path",
    oracle="SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')",
)
def scan_multi_path(spark, sf_dir):
    root = partitioned_customer(spark, sf_dir)
    paths = [f"{root}/c_mktsegment=BUILDING", f"{root}/c_mktsegment=MACHINERY"]
    return files.read_partitioned(spark, paths, base_path=root)


def _customer_csv(spark, sf_dir, delimiter: str) -> str:
    def build(path):
        c = _t(spark, sf_dir).customer
        return files.write(c, path, "csv", mode="overwrite", options={"header": "true", "delimiter": delimiter})

    return _once(spark, sf_dir, f"customer-csv-{ord(delimiter)}", build)


_SQL_CUSTOMER_INFERRED = (
    "CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
)


@query("scan_csv_infer", oracle=f"SELECT {_SQL_CUSTOMER_INFERRED}")
def scan_csv_infer(spark, sf_dir):
    """Header row names the columns; a second pass infers int/double."""
    return files.read_csv(spark, _customer_csv(spark, sf_dir, ","))


@query("scan_csv_delim", oracle=f"SELECT {_SQL_CUSTOMER_INFERRED}")
def scan_csv_delim(spark, sf_dir):
    return files.read_csv(spark, _customer_csv(spark, sf_dir, ";"), delimiter=";")


CUSTOMER_SCHEMA = StructType(
    [
        StructField("c_custkey", LongType()),
        StructField("c_name", StringType()),
        StructField("c_nationkey", IntegerType()),
        StructField("c_acctbal", DoubleType()),
        StructField("c_mktsegment", StringType()),
    ]
)


@query("scan_csv_pushdown", oracle="SELECT * FROM customer WHERE c_acctbal > 5000")
def scan_csv_pushdown(spark, sf_dir):
    """Explicit schema (no inference pass); the filter is pushed into the CSV reader."""
    df = files.read_csv(spark, _customer_csv(spark, sf_dir, ","), schema=CUSTOMER_SCHEMA)
    return df.where(F.col("c_acctbal") > 5000)


def _customer_json(spark, sf_dir) -> str:
    def build(path):
        return files.write(_t(spark, sf_dir).customer, path, "json", mode="overwrite")

    return _once(spark, sf_dir, "customer-json", build)


@query(
    "scan_json_infer",
    oracle="SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def scan_json_infer(spark, sf_dir):
    """Inferred JSON schema: columns in name order, whole numbers as bigint."""
    return files.read(spark, _customer_json(spark, sf_dir), "json")


@query("scan_json_schema", oracle="SELECT * FROM customer")
def scan_json_schema(spark, sf_dir):
    return files.read(spark, _customer_json(spark, sf_dir), "json", schema=CUSTOMER_SCHEMA)


@query("scan_orc", oracle="SELECT * FROM orders")
def scan_orc(spark, sf_dir):
    def build(path):
        return files.write(_t(spark, sf_dir).orders, path, "orc", mode="overwrite")

    return files.read(spark, _once(spark, sf_dir, "orders-orc", build), "orc")


@query(
    "scan_merge_schema",
    oracle="""
SELECT o_orderkey, o_custkey, o_totalprice, NULL::VARCHAR AS o_orderpriority, CAST(1 AS INTEGER) AS batch
FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_custkey, NULL::DOUBLE AS o_totalprice, o_orderpriority, CAST(2 AS INTEGER) AS batch
FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F'""",
)
def scan_merge_schema(spark, sf_dir):
    """Two batches with different column sets; mergeSchema unions the columns."""
    o = _t(spark, sf_dir).orders
    root = scratch_path(spark, "merge-schema")
    files.write(o.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice"), f"{root}/batch=1")
    files.write(
        o.where("not o_orderstatus <=> 'F'").select("o_orderkey", "o_custkey", "o_orderpriority"), f"{root}/batch=2"
    )
    return files.read_partitioned(spark, root, merge_schema=True)


@query("scan_pushed_filter", oracle="SELECT * FROM lineitem WHERE l_quantity > 45")
def scan_pushed_filter(spark, sf_dir):
    """The predicate is checked against row-group statistics (PushedFilters)."""
    return files.read(spark, f"{sf_dir}/lineitem.parquet").where(F.col("l_quantity") > 45)


@query("scan_pruned_columns", oracle="SELECT l_orderkey, l_extendedprice FROM lineitem")
def scan_pruned_columns(spark, sf_dir):
    """Only the two selected columns are read (ReadSchema)."""
    return files.read(spark, f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_extendedprice")


@query(
    "scan_pruned_partitions",
    oracle=f"SELECT {SQL_ORDERS_YM} FROM orders WHERE year(o_orderdate) = 1996 AND month(o_orderdate) = 1",
)
def scan_pruned_partitions(spark, sf_dir):
    """A filter on partition columns lists only the matching folders (PartitionFilters)."""
    df = files.read_partitioned(spark, partitioned_orders(spark, sf_dir))
    return df.where((F.col("o_year") == 1996) & (F.col("o_month") == 1))


# ------------------------------------------------------------------ 2.2 sinks


def _round_trip(spark, df: DataFrame, tag: str, fmt: str = "parquet", read_schema=None, read_options=None, **kw) -> DataFrame:
    path = scratch_path(spark, tag)
    files.write(df, path, fmt, **kw)
    return files.read(spark, path, fmt, schema=read_schema, options=read_options)


@query("sink_parquet", oracle="SELECT * FROM orders")
def sink_parquet(spark, sf_dir):
    return _round_trip(spark, _t(spark, sf_dir).orders, "sink-parquet")


SINK_CODECS = ("snappy", "gzip", "zstd", "lz4", "none")


@query(
    "sink_parquet_codecs",
    oracle="\nUNION ALL\n".join(f"SELECT '{c}' AS codec, * FROM orders" for c in SINK_CODECS),
)
def sink_parquet_codecs(spark, sf_dir):
    """Same rows back whatever the codec."""
    o = _t(spark, sf_dir).orders
    parts = [
        _round_trip(spark, o, f"codec-{c}", compression=c).select(F.lit(c).alias("codec"), "*") for c in SINK_CODECS
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("sink_orc", oracle="SELECT * FROM orders")
def sink_orc(spark, sf_dir):
    return _round_trip(spark, _t(spark, sf_dir).orders, "sink-orc", "orc", compression="zlib")


@query(
    "sink_json",
    oracle="SELECT c_custkey, c_name, c_nationkey, c_acctbal, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer",
)
def sink_json(spark, sf_dir):
    """JSON lines, gzip; NULL fields are left out of each object and read back as NULL."""
    c = _t(spark, sf_dir).customer.withColumn("c_mktsegment", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))
    return _round_trip(spark, c, "sink-json", "json", read_schema=CUSTOMER_SCHEMA, compression="gzip")


CSV_OPTIONS = {"header": "true", "delimiter": ";", "quote": '"', "escape": "\\"}


@query("sink_csv", oracle="SELECT * FROM customer")
def sink_csv(spark, sf_dir):
    c = _t(spark, sf_dir).customer
    return _round_trip(
        spark, c, "sink-csv", "csv", read_schema=CUSTOMER_SCHEMA, read_options=CSV_OPTIONS, compression="gzip", options=CSV_OPTIONS
    )


@query("sink_partitioned_one", oracle="SELECT * FROM customer")
def sink_partitioned_one(spark, sf_dir):
    c = _t(spark, sf_dir).customer
    path = files.write_clustered(c, scratch_path(spark, "by-segment"), ["c_mktsegment"])
    return files.read_partitioned(spark, path)


@query("sink_partitioned_many", oracle=f"SELECT {SQL_ORDERS_YM} FROM orders")
def sink_partitioned_many(spark, sf_dir):
    o = orders_with_year_month(_t(spark, sf_dir).orders)
    path = files.write_clustered(o, scratch_path(spark, "by-year-month"), ["o_year", "o_month"])
    return files.read_partitioned(spark, path)


@query("sink_partitioned_codec", oracle=f"SELECT {SQL_ORDERS_YM} FROM orders")
def sink_partitioned_codec(spark, sf_dir):
    o = orders_with_year_month(_t(spark, sf_dir).orders)
    path = files.write_clustered(o, scratch_path(spark, "by-ym-zstd"), ["o_year", "o_month"], compression="zstd")
    return files.read_partitioned(spark, path)


def folder_report(spark, df, keys: list[str]):
    """Rows of each folder of a clustered write, and whether its files are few: a
    folder has one file unless it is larger than the advisory size, and then none
    of its files is a small fragment."""
    stats = files.with_file_info(df).groupBy(*keys, "file_path").agg(
        F.first("file_size").alias("bytes"), F.count(F.lit(1)).alias("n")
    )
    folders = stats.groupBy(*keys).agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
    # files are smaller than the shuffled bytes that the advisory size counts
    least = files.advisory_bytes(spark) / 64
    fits = (F.col("files") == 1) | (F.col("bytes") / F.col("files") >= least)
    return folders.select(*keys, "rows", fits.alias("few_files"))


@query(
    "sink_clustered_partitions",
    oracle="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS o_year, CAST(month(o_orderdate) AS INTEGER) AS o_month,
       COUNT(*) AS rows, TRUE AS few_files
FROM orders WHERE o_totalprice > 0 GROUP BY 1, 2""",
)
def sink_clustered_partitions(spark, sf_dir):
    """Keep positive totals, add year and month, cluster by them, write; read back
    the rows of each folder and whether its files are few."""
    o = orders_with_year_month(_t(spark, sf_dir).orders.where(F.col("o_totalprice") > 0))
    o = o.select("o_orderkey", "o_custkey", "o_totalprice", "o_year", "o_month")
    path = files.write_clustered(o, scratch_path(spark, "clustered"), ["o_year", "o_month"], compression="snappy")
    return folder_report(spark, files.read_partitioned(spark, path), ["o_year", "o_month"])


@query(
    "sink_file_count",
    oracle="""
SELECT 'repartition' AS layout, TRUE AS as_requested, COUNT(*) AS rows FROM orders
UNION ALL
SELECT 'repartition_coalesce', TRUE, COUNT(*) FROM orders""",
)
def sink_file_count(spark, sf_dir):
    """A requested number of output files: repartition(n) spreads rows evenly over
    n tasks; coalesce(m) then merges them without another shuffle.  The counts
    are the session's shuffle partitions and half of them."""
    o = _t(spark, sf_dir).orders
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    layouts = {"repartition": (o.repartition(n), n), "repartition_coalesce": (o.repartition(n).coalesce(max(1, n // 2)), max(1, n // 2))}
    parts = []
    for name, (df, requested) in layouts.items():
        back = files.with_file_info(_round_trip(spark, df, f"files-{name}"))
        counted = back.agg(F.count_distinct("file_path").alias("files"), F.count(F.lit(1)).alias("rows"))
        parts.append(counted.select(F.lit(name).alias("layout"), (F.col("files") == requested).alias("as_requested"), "rows"))
    return parts[0].unionByName(parts[1])


@query(
    "sink_one_file_per_partition",
    oracle="SELECT o_orderpriority, COUNT(*) AS rows, TRUE AS few_files FROM orders GROUP BY o_orderpriority",
)
def sink_one_file_per_partition(spark, sf_dir):
    """One file per partition value, written in parallel (one task per value,
    more only for a value above the advisory size)."""
    o = _t(spark, sf_dir).orders
    path = files.write_clustered(o, scratch_path(spark, "one-file"), ["o_orderpriority"])
    return folder_report(spark, files.read_partitioned(spark, path), ["o_orderpriority"])


MAX_RECORDS = 100_000


@query("sink_max_records", oracle="SELECT CAST(0 AS BIGINT) AS files_over_cap, COUNT(*) AS rows FROM lineitem")
def sink_max_records(spark, sf_dir):
    """maxRecordsPerFile caps rows per file; report files above the cap (0)."""
    back = files.file_stats(_round_trip(spark, _t(spark, sf_dir).lineitem, "max-records", max_records_per_file=MAX_RECORDS))
    return back.agg(
        F.count(F.when(F.col("rows") > MAX_RECORDS, 1)).alias("files_over_cap"), F.sum("rows").alias("rows")
    )


@query(
    "sink_dynamic_overwrite",
    oracle="""
SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1996 THEN 'R' ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS o_year
FROM orders""",
)
def sink_dynamic_overwrite(spark, sf_dir):
    """Dynamic partition overwrite: only the years present in the new rows
    are replaced, every other year is kept."""
    o = _t(spark, sf_dir).orders.select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.year("o_orderdate").alias("o_year")
    )
    path = scratch_path(spark, "dynamic")
    files.write_clustered(o, path, ["o_year"])
    revised = o.where(F.col("o_year") == 1996).withColumn("o_orderstatus", F.lit("R"))
    files.write_clustered(revised, path, ["o_year"], mode="overwrite", dynamic_overwrite=True)
    return files.read_partitioned(spark, path)


@query("sink_save_modes", oracle="SELECT * FROM orders UNION ALL SELECT * FROM orders")
def sink_save_modes(spark, sf_dir):
    """overwrite replaces, append adds, ignore does nothing when data exists."""
    o = _t(spark, sf_dir).orders
    path = scratch_path(spark, "modes")
    files.write(o, path, mode="overwrite")
    files.write(o, path, mode="overwrite")
    files.write(o, path, mode="append")
    files.write(o, path, mode="ignore")
    return files.read(spark, path)


@query("sink_bucketed", oracle="SELECT * FROM orders")
def sink_bucketed(spark, sf_dir):
    """Bucketed and sorted table (bucketing needs a catalog table)."""
    from quarry.operators.catalog import save_bucketed

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = save_bucketed(_t(spark, sf_dir).orders, "orders_b", n, "o_custkey", sort_by=["o_orderdate"])
    return spark.table(name)


@query("sink_table", oracle="SELECT * FROM orders")
def sink_table(spark, sf_dir):
    """Partitioned parquet table saved in the catalog, read by name."""
    from quarry.operators.catalog import save_table

    name = save_table(_t(spark, sf_dir).orders, "orders_t", partition_by=["o_orderpriority"])
    return spark.table(name)


@query(
    "sink_default_codec",
    oracle="""
SELECT 'parquet' AS format, 'zstd' AS codec, COUNT(*) AS rows FROM orders
UNION ALL SELECT 'orc', 'zstd', COUNT(*) FROM orders""",
)
def sink_default_codec(spark, sf_dir):
    """The session-wide parquet and ORC codecs, set for one write and restored after."""
    parts = []
    for fmt in ("parquet", "orc"):
        key = f"spark.sql.{fmt}.compression.codec"
        before = spark.conf.get(key)
        path = scratch_path(spark, f"default-codec-{fmt}")
        try:
            spark.conf.set(key, "zstd")
            files.write(_t(spark, sf_dir).orders, path, fmt)
        finally:
            spark.conf.set(key, before)
        codec = F.regexp_extract(F.col("_metadata.file_name"), rf"\.([a-z0-9]+)\.{fmt}$", 1)
        back = files.read(spark, path, fmt).withColumn("codec", codec)
        parts.append(back.groupBy(F.lit(fmt).alias("format"), "codec").agg(F.count(F.lit(1)).alias("rows")))
    return parts[0].unionByName(parts[1])


REPORT_LAYOUTS = [
    ("parquet", "snappy"),
    ("parquet", "gzip"),
    ("parquet", "zstd"),
    ("parquet", "none"),
    ("orc", "zlib"),
    ("orc", "zstd"),
    ("json", "none"),
    ("json", "gzip"),
    ("csv", "none"),
    ("csv", "gzip"),
]


def _report_oracle() -> str:
    parts = [f"SELECT '{f}' AS format, '{c}' AS codec, COUNT(*) AS rows, TRUE AS stored FROM orders" for f, c in REPORT_LAYOUTS]
    return "\nUNION ALL\n".join(parts)


def format_sizes(spark, df) -> DataFrame:
    """Write the same rows in several formats and codecs: files, bytes and rows of each."""
    parts = []
    for fmt, codec in REPORT_LAYOUTS:
        opts = {"header": "true"} if fmt == "csv" else {}
        path = files.write(df, scratch_path(spark, f"report-{fmt}-{codec}"), fmt, compression=codec, options=opts)
        back = files.read(spark, path, fmt, schema=df.schema if fmt in ("csv", "json") else None, options=opts)
        stats = files.file_stats(back).agg(
            F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")
        )
        parts.append(stats.select(F.lit(fmt).alias("format"), F.lit(codec).alias("codec"), "files", "bytes", "rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("report_format_size", oracle=_report_oracle())
def report_format_size(spark, sf_dir):
    """Rows of each format and codec, and whether it stored any bytes (sizes depend on
    the library versions, so ``format_sizes`` has them and the query does not)."""
    sizes = format_sizes(spark, _t(spark, sf_dir).orders)
    return sizes.select("format", "codec", "rows", (F.col("bytes") > 0).alias("stored"))
