"""Golden results G0-G12 on the literal study tables (FIXTURES.md part C)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from quarry.operators import history as hist
from quarry.operators import joins, ordered
from tests import fixtures as fx


@pytest.fixture(scope="module")
def staff(spark):
    return spark.createDataFrame(fx.STAFF, fx.STAFF_COLUMNS)


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame(fx.SALES, fx.SALES_COLUMNS)


def test_g0_inferred_and_explicit_schema(spark, staff):
    types = dict(staff.dtypes)
    assert types["id"] == "bigint" and types["salario"] == "double" and types["data_contratacao"] == "string"
    schema = StructType(
        [StructField("id", IntegerType(), False)]
        + [StructField(c, t, True) for c, t in [("nome", StringType()), ("departamento", StringType()),
                                                 ("salario", DoubleType()), ("data_contratacao", StringType()),
                                                 ("dept_id", LongType())]]
    )
    explicit = spark.createDataFrame(fx.STAFF, schema)
    assert explicit.schema["id"].dataType == IntegerType() and not explicit.schema["id"].nullable
    assert explicit.schema["nome"].nullable


def test_g1_having_stddev(staff):
    out = (
        staff.groupBy("departamento")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("salario").alias("total"), F.avg("salario").alias("avg"),
             F.round(F.stddev("salario"), 2).alias("sd"))
        .where(F.col("n") > 1)
        .orderBy(F.desc("avg"))
        .collect()
    )
    assert [(r.departamento, r.n, r.total, round(r.avg, 2), r.sd) for r in out] == [
        ("TI", 3, 22000.0, 7333.33, 763.76),
        ("Vendas", 2, 9500.0, 4750.0, 353.55),
    ]


def test_g2_scalar_subquery(staff):
    above = staff.where(F.col("salario") > staff.select(F.avg("salario")).scalar())
    assert sorted(r.nome for r in above.collect()) == ["Carlos", "Julia", "Maria"]


def test_g3_left_join_aggregate(staff, sales):
    out = joins.aggregate_then_join(
        staff, sales, "id", "funcionario_id",
        [F.sum("valor").alias("total"), F.count("venda_id").alias("n")], how="left",
    ).select("nome", F.coalesce("total", F.lit(0.0)).alias("total"), F.coalesce("n", F.lit(0)).alias("n"))
    got = {r.nome: (r.total, r.n) for r in out.collect()}
    assert got["João"] == (37000.0, 3) and got["Pedro"] == (17500.0, 2)
    assert sorted(k for k, v in got.items() if v == (0.0, 0)) == ["Ana", "Carlos", "Julia", "Maria"]


def test_g4_correlated_max(staff):
    top = staff.groupBy("departamento").agg(F.max("salario").alias("salario"))
    out = staff.join(top, ["departamento", "salario"], "left_semi")
    assert sorted(r.nome for r in out.collect()) == ["Ana", "Carlos", "João"]


def test_g5_running_total(sales):
    out = ordered.with_positions(
        sales, ["data_venda"], ["venda_id"], name="pos", running={"running": F.col("valor")}, partitions=3
    ).orderBy("pos")
    assert [r.running for r in out.collect()] == [10000.0, 18000.0, 33000.0, 42500.0, 54500.0]


def test_g6_g7_g8_set_operations(staff):
    ti = staff.where(F.col("departamento") == "TI").select("nome")
    assert staff.where(F.col("departamento") == "TI").select("nome", "departamento").union(
        staff.where(F.col("salario") > 6000).select("nome", "departamento")).count() == 6
    assert sorted(r.nome for r in ti.intersect(staff.where(F.col("salario") > 6000).select("nome")).collect()) == [
        "Carlos", "Julia", "Maria"]
    assert [r.nome for r in ti.subtract(staff.where(F.col("salario") > 7000).select("nome")).collect()] == ["Julia"]


def test_g9_ntile(staff):
    out = ordered.with_ntile(staff, 4, ["salario"], ["id"], name="q", partitions=3)
    got = {r.nome: r.q for r in out.collect()}
    assert got == {"Pedro": 1, "João": 1, "Ana": 2, "Julia": 2, "Maria": 3, "Carlos": 4}


def test_g10_inner_join_total(staff, sales):
    out = joins.aggregate_then_join(staff, sales, "id", "funcionario_id", [F.sum("valor").alias("total")], how="inner")
    assert {r.nome: r.total for r in out.collect()} == {"João": 37000.0, "Pedro": 17500.0}


@pytest.fixture(scope="module")
def products_table(spark):
    schema = StructType(
        [
            StructField("id", LongType(), False),
            StructField("produto", StringType(), False),
            StructField("categoria", StringType(), True),
            StructField("quantidade", LongType(), False),
            StructField("preco_unitario", DoubleType(), False),
            StructField("data_venda", DateType(), False),
            StructField("regiao", StringType(), True),
        ]
    )
    h = hist.create(spark, schema, dt.datetime(2024, 1, 1))
    h = hist.append(h, spark.createDataFrame(fx.PRODUCTS_FIRST, schema), dt.datetime(2024, 1, 2))
    return hist.append(h, spark.createDataFrame(fx.PRODUCTS_SECOND, schema), dt.datetime(2024, 1, 3))


def test_g11_time_travel(products_table):
    assert hist.as_of(products_table, 1).count() == 5
    assert hist.as_of(products_table).count() == 7
    assert hist.as_of(products_table, 0).count() == 0


def test_g12_row_filter(products_table):
    rows = hist.as_of(products_table, 1).where("quantidade > 20 AND regiao = 'Sul'").collect()
    assert [(r.produto, r.quantidade) for r in rows] == [("Teclado", 30)]
