import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentscope.functions.clean import blank_to_null, digits_int, is_non_residential, safe_int


def _one_col(spark, values, dtype):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("x", dtype)]))


def test_digits_int_text(spark):
    df = _one_col(spark, ["3", "5+", "", None, "abc", "12 rooms"], T.StringType())
    got = [r[0] for r in df.select(digits_int(F.col("x"), T.StringType())).collect()]
    assert got == [3, 5, None, None, None, 12]


def test_digits_int_numeric_casts_directly(spark):
    df = _one_col(spark, [3.0, 2.5, None], T.DoubleType())
    got = [r[0] for r in df.select(digits_int(F.col("x"), T.DoubleType())).collect()]
    assert got == [3, 2, None]  # 3.0 -> 3 (the text route would give 30); doubles round half-even
    df = _one_col(spark, [4, None], T.LongType())
    assert [r[0] for r in df.select(digits_int(F.col("x"), T.LongType())).collect()] == [4, None]


def test_safe_int(spark):
    df = _one_col(spark, ["3", "2.5", "4.0", "x", None], T.StringType())
    got = [r[0] for r in df.select(safe_int(F.col("x"), T.StringType())).collect()]
    assert got == [3, 3, 4, None, None]  # text rounds half up


def test_blank_to_null(spark):
    df = _one_col(spark, ["", "-", "NORTE", None], T.StringType())
    assert [r[0] for r in df.select(blank_to_null(F.col("x"))).collect()] == [None, None, "NORTE", None]


def test_non_residential_is_case_insensitive(spark):
    df = _one_col(spark, ["Bodega", "apartamento", "LOTE"], T.StringType())
    assert [r[0] for r in df.select(is_non_residential(F.col("x"))).collect()] == [True, False, True]


def test_hard_float_cast_fails_on_text(spark):
    df = _one_col(spark, ["12.5", "abc"], T.StringType())
    with pytest.raises(Exception):
        df.select(F.col("x").cast("float")).collect()
