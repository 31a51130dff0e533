"""Exact rounding helpers agree with decimal arithmetic (half away from zero)."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderflow.functions.numeric import idiv, pct, round_ratio, tenths


def expected(n, d, k):
    return float((Decimal(n) / Decimal(d)).quantize(Decimal(1).scaleb(-k), rounding=ROUND_HALF_UP))


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(1, 10**6),
                          st.integers(0, 2)), min_size=200, max_size=200))
def test_round_ratio(spark, rows):
    rows = rows + [(1, 20, 1), (3, 20, 1), (-5, 2, 0), (5, 2, 0), (1005, 1000, 2), (0, 7, 1)]
    df = spark.createDataFrame(rows, "n long, d long, k int")
    out = {}
    for k in (0, 1, 2):
        for r in df.filter(F.col("k") == k).select(
                "n", "d", round_ratio(F.col("n"), F.col("d"), k).alias("v")).collect():
            out[(r.n, r.d, k)] = r.v
    for n, d, k in rows:
        assert out[(n, d, k)] == expected(n, d, k), (n, d, k)


def test_zero_denominator_is_null(spark):
    r = spark.range(1).select(round_ratio(F.lit(5), F.lit(0), 1).alias("v")).first()
    assert r.v is None


def test_idiv_floors(spark):
    r = spark.range(1).select(idiv(F.lit(-7), 2).alias("a"), idiv(F.lit(7), 2).alias("b")).first()
    assert (r.a, r.b) == (-4, 3)


def test_exact_beyond_double(spark):
    r = spark.range(1).select(
        idiv(F.lit(90071992547409931), 10).alias("a"), idiv(F.lit(-90071992547409931), 7).alias("b"),
        pct(F.lit(int(1.8e16)), F.lit(int(1e17))).alias("c"),
        round_ratio(F.lit(9 * 10**18), F.lit(7), 2).alias("d"), tenths(F.lit(-5), F.lit(10)).alias("e")).first()
    assert (r.a, r.b) == (9007199254740993, -90071992547409931 // 7)
    assert (r.c, r.e) == (18.0, -500) and r.d == expected(9 * 10**18, 7, 2)


def test_floor_division_near_ten_to_the_seventeen(spark):
    df = spark.range(10**17, 10**17 + 2000).select("id", idiv(F.col("id"), 7).alias("q"))
    assert all(r.q == r.id // 7 for r in df.collect())
