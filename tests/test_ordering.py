"""Global order by keys of any type."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from terrapix.operators import ordering

N = 16


def check(spark, rows, schema, order, n=N, most=None):
    df = spark.createDataFrame(rows, schema).repartition(5)
    names = [c.split()[0] for c in schema.split(", ")]
    out = ordering.running_totals(df, order, ["v"], n=n, row_number="rn").collect()

    def key(r):
        return [(r[c] is not None, r[c].encode() if isinstance(r[c], str) else bytes(r[c]) if isinstance(r[c], bytearray) else r[c]) if r[c] is not None else (False,) for c in order]
    want, total = {}, 0
    for k, r in enumerate(sorted((dict(zip(names, r)) for r in rows), key=key), 1):
        total += r["v"]
        want[r["id"]] = (k, total)
    assert {r["id"]: (r["rn"], r["cum_v"]) for r in out} == want
    sizes = [r["count"] for r in df.groupBy(ordering.range_bucket(df, order, n).alias("b")).count().collect()]
    assert max(sizes) <= (most or 2 * -(-len(rows) // n)), sorted(sizes)


def strings(kind, rng, n):
    letters = "abcdefgh"
    word = lambda k: "".join(rng.choice(letters) for _ in range(k))
    if kind == "spread":
        return [word(12) for _ in range(n)]
    if kind == "one prefix":  # all share 20 bytes
        return ["task_worker_00000000" + word(6) for _ in range(n)]
    if kind == "hot prefix":  # two thirds share a prefix, one third is spread
        return ["s3a://bucket/" + word(5) if rng.random() < 0.66 else word(9) for _ in range(n)]
    if kind == "hot value":  # two thirds are one value: the id cuts them
        return ["same" if rng.random() < 0.66 else word(6) for _ in range(n)]
    return [rng.choice(["", "a", "a\x00", "é", "日本語", "🙂", "ab", "a b", "Z", "z" * 50]) + rng.choice(["", word(3)]) for _ in range(n)]


@pytest.mark.parametrize("kind", ["spread", "one prefix", "hot prefix", "hot value", "odd"])
def test_string_keys(spark, kind):
    rng = random.Random(kind)
    rows = [(s, k, rng.randrange(9)) for k, s in enumerate(strings(kind, rng, 640))] + [(None, 1000, 1)]
    check(spark, rows, "s string, id long, v long", ["s", "id"], most=120)


@pytest.mark.parametrize("typ", ["binary", "boolean", "date", "timestamp", "double", "decimal(20,3)"])
def test_other_keys(spark, typ):
    import decimal
    rng = random.Random(typ)
    make = {"binary": lambda: bytearray(rng.randbytes(rng.randrange(9))), "boolean": lambda: rng.random() < 0.3, "date": lambda: dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(40)),
            "timestamp": lambda: dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=rng.randrange(10 ** 12)), "double": lambda: rng.choice([float("inf"), -0.5, rng.gauss(0, 1)]),
            "decimal(20,3)": lambda: decimal.Decimal(rng.randrange(10 ** 6)) / 1000}[typ]
    rows = [(make() if rng.random() < 0.95 else None, k, rng.randrange(9)) for k in range(500)]
    check(spark, rows, f"s {typ}, id long, v long", ["s", "id"], most=90)


def test_many_buckets_need_no_large_tree(spark):
    df = spark.range(20_000).selectExpr("id", "CAST(id * 7919 % 20011 AS DOUBLE) AS x", "1 AS v")
    bucket = ordering.range_bucket(df, ["x"], 1_000)
    sizes = df.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("b").collect()
    assert 900 <= len(sizes) <= 1_000 and max(r["n"] for r in sizes) <= 60
    assert all(a["hi"] < b["lo"] for a, b in zip(sizes, sizes[1:]))


def test_empty_and_one_bucket(spark):
    df = spark.createDataFrame([], "s string, v long")
    assert ordering.running_totals(df, ["s"], ["v"], n=4).count() == 0
    one = spark.createDataFrame([("b", 2), ("a", 1)], "s string, v long")
    assert [r["cum_v"] for r in ordering.running_totals(one, ["s"], ["v"], n=1).orderBy("s").collect()] == [1, 3]
