import random

from pyspark.sql import functions as F

from tallyspark.functions.ordering import positions, running_sums
from tallyspark.session import stored


def rows():
    rng = random.Random(5)
    out = [("a" if rng.random() < .6 else rng.choice(["b", None, "c"]), rng.randrange(40), i, rng.choice([0, 1, 7])) for i in range(700)]
    return out + [("lone", None, 1000, 3)]


def expected(data, value):
    first = lambda x: (x is not None, x)
    out, seen = {}, {}
    for g, a, i, v in sorted(data, key=lambda r: (first(r[0]), first(r[1]), r[2])):
        out[i] = seen.get(g, 0)
        seen[g] = seen.get(g, 0) + value(v)
    return out, seen


def test_positions_and_running_sums_equal_a_sorted_walk(spark):
    data = rows()
    df = stored(spark.createDataFrame(data, "g string, a int, i long, v long"), "test")
    got = positions(df, ["g"], ["a", "i"], "p", "n").collect()
    want, total = expected(data, lambda v: 1)
    assert {r.i: r.p for r in got} == want and all(r.n == total[r.g] for r in got)
    got = running_sums(df, ["g"], ["a", "i"], "v", "p", "n").collect()
    want, total = expected(data, lambda v: v)
    assert {r.i: r.p for r in got} == want and all(r.n == total[r.g] for r in got)


def test_order_without_groups_and_descending(spark):
    data = rows()
    df = stored(spark.createDataFrame(data, "g string, a int, i long, v long"), "test")
    got = positions(df, [], [F.col("i").desc()], "p").collect()
    assert sorted(r.p for r in got) == list(range(len(data)))
    assert [r.i for r in sorted(got, key=lambda r: r.p)] == sorted((r[2] for r in data), reverse=True)


def test_empty_table(spark):
    df = stored(spark.createDataFrame([], "g string, a int, i long, v long"), "test")
    assert positions(df, ["g"], ["a", "i"]).collect() == [] and running_sums(df, ["g"], ["a"], "v").collect() == []
