"""Nearest-rank statistics from the value histogram."""

from orderflow.operators.blocks import nearest_rank_stats


def test_p90_is_row_at_round_of_090n(spark):
    values = list(range(1, 39))            # n = 38 -> rank round(34.2) = 34
    df = spark.createDataFrame([("x", v) for v in values], "g string, v long")
    r = nearest_rank_stats(df, ["g"], "v").first()
    assert r.n == 38 and r.p90_value == 34
    assert r.median_value == 20.0          # mean of ranks 19 and 20 = 19.5 -> 20 (half away)


def test_median_with_duplicates(spark):
    df = spark.createDataFrame([("x", v) for v in [1, 1, 1, 5, 9, 9]], "g string, v long")
    r = nearest_rank_stats(df, ["g"], "v").first()
    assert r.median_value == 3.0 and r.min_value == 1 and r.max_value == 9


def test_ntile_from_rank_equals_ntile(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from orderflow.operators.blocks import ntile_from_rank
    rows = [(n, r) for n in range(1, 41) for r in range(1, n + 1)]
    df = spark.createDataFrame(rows, "n long, r long")
    w = Window.partitionBy("n").orderBy("r")
    bad = (df.select("n", "r", F.ntile(4).over(w).alias("want"),
                     ntile_from_rank(F.col("r"), F.col("n"), 4).alias("got"))
           .filter(F.col("want") != F.col("got")))
    assert bad.count() == 0
