"""Trim, blank -> NULL, tolerant casts."""
from pyspark.sql import types as T

from starledger.contracts import Col, TableContract
from starledger.operators.conform import conform

C = TableContract("t", (Col("s", T.StringType(), "varchar(10)"), Col("i", T.IntegerType(), "int"),
                        Col("d", T.DateType(), "date"), Col("m", T.DecimalType(18, 2), "decimal(18,2)")))


def run(spark, rows):
    df = spark.createDataFrame(rows, "s string, i string, d string, m string, extra string")
    return [tuple(r) for r in conform(df, C).collect()]


def test_trim_and_blank(spark):
    out = run(spark, [(" x ", " 12 ", "2023-01-05", "12.345", "drop me"), ("", "   ", "", "", None)])
    assert out[0][0] == "x" and out[0][1] == 12 and str(out[0][3]) == "12.35"
    assert out[1] == (None, None, None, None)


def test_tolerant_casts(spark):
    out = run(spark, [("a", "12.7", "2023-02-30", "abc", None), ("b", "abc", "2023-1-5", "1.5", None),
                      ("c", "99999999999", "20230105", None, None)])
    assert out[0][1] is None            # X2: try_cast('12.7' as int) is NULL
    assert out[0][2] is None and out[0][3] is None
    assert out[1][1] is None and str(out[1][2]) == "2023-01-05"
    assert out[2][1] is None and out[2][2] is None   # overflow / compact date -> NULL


def test_tab_survives_trim(spark):
    out = run(spark, [("\tx", None, None, None, None)])
    assert out[0][0] == "\tx"           # X3: trim removes spaces only


def test_contract_projection(spark):
    df = spark.createDataFrame([("a", "1", None, None, "z")], "s string, i string, d string, m string, extra string")
    assert conform(df, C).columns == ["s", "i", "d", "m"]
