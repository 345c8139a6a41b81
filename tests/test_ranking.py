import random

from pyspark.sql import functions as F

from taxaweave.operators.ranking import exact_median, number_rows, running_sum


def sample(spark, rows=500):
    rng = random.Random(4)
    data = [("hot" if rng.random() < 0.5 else f"g{rng.randrange(5)}", rng.randrange(50), i) for i in range(rows)]
    return data, spark.createDataFrame(data, "g string, v int, id int").repartition(5)


def test_ranges_equal_plain_window(spark):
    data, df = sample(spark)
    for limit in (10_000, 20):
        got = {(r["g"], r["id"]): r["rank"] for r in number_rows(df, ["v", "id"], ["g"], rows_per_task=limit, ranges=8).collect()}
        for group in {d[0] for d in data}:
            ordered = sorted((v, i) for g, v, i in data if g == group)
            assert [got[group, i] for _, i in ordered] == list(range(1, len(ordered) + 1))


def test_whole_table_in_ranges(spark):
    data, df = sample(spark)
    got = number_rows(df, [-F.col("v"), "g", "id"], rows_per_task=10, ranges=16).orderBy("rank").collect()
    assert [(r["v"], r["g"], r["id"]) for r in got] == [(v, g, i) for v, g, i in sorted(
        ((v, g, i) for g, v, i in data), key=lambda x: (-x[0], x[1], x[2]))]


def test_null_and_text_order(spark):
    df = spark.createDataFrame([(None, 1), ("b", 2), ("a", 3), (None, 4), ("c", 5)], "k string, id int")
    for limit in (100, 1):
        got = number_rows(df, ["k", "id"], rows_per_task=limit, ranges=3).orderBy("rank").collect()
        assert [r["id"] for r in got] == [1, 4, 3, 2, 5]


def test_median_and_running_sum(spark):
    import statistics

    data, df = sample(spark)
    for limit in (10_000, 5):
        got = {r["g"]: r["median"] for r in exact_median(df, ["g"], "v", rows_per_task=limit).collect()}
        assert got == {g: statistics.median(v for h, v, _ in data if h == g) for g in {d[0] for d in data}}
        sums = running_sum(df, "v", ["id"], ["g"], rows_per_task=limit, ranges=8).collect()
        for r in sums:
            assert r["running"] == sum(v for g, v, i in data if g == r["g"] and i <= r["id"])
