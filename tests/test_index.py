"""Positions and running sums do not depend on buckets, partitions or skew."""

import random

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import index


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, and null keys."""
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else (None if i % 50 == 0 else f"k{rng.randrange(200)}")
        rows.append((key, rng.randrange(1_000_000) * 4000 + i, rng.randrange(0, 40)))
    return spark.createDataFrame(rows, "k string, id bigint, w bigint").repartition(5).cache()


@pytest.mark.parametrize("per_bucket", [7, 100, 100_000])
def test_global_index(skewed, per_bucket):
    got = index.global_index(skewed, ["k", "id"], rows_per_bucket=per_bucket).collect()
    expected = sorted(((r["k"] or "", r["id"]) for r in got))
    assert [(r["k"] or "", r["id"]) for r in sorted(got, key=lambda r: r["index"])] == expected
    assert sorted(r["index"] for r in got) == list(range(3000))


@pytest.mark.parametrize("per_bucket", [50, 100_000])
def test_prefix_sums_by_partition(skewed, per_bucket):
    got = index.prefix_sums(skewed, ["id"], weight="w", partition=["k"], out="before", rows_per_bucket=per_bucket)
    seen = {}
    for r in sorted(got.collect(), key=lambda r: (r["k"] or "", r["id"])):
        assert r["before"] == seen.get(r["k"], 0)
        seen[r["k"]] = seen.get(r["k"], 0) + r["w"]


def test_hot_key_is_spread_over_buckets(skewed):
    buckets = 30
    cut_by, edges = index._edges(skewed, ["k", "id"], 3000, buckets)
    assert cut_by == ["k", "id"]
    sizes = skewed.groupBy(index.edges_at_or_below(skewed, cut_by, edges).alias("b")).count()
    assert sizes.agg(F.max("count")).first()[0] < 3000 / buckets * 4


@pytest.mark.parametrize("n", [1, 3, 7, 11])
def test_shard_contiguous_like_near_equal_cuts(spark, n):
    ids = spark.range(10).select(F.col("id"))
    got = [r["shard"] for r in index.shard_contiguous(ids, n, ["id"], rows_per_bucket=3).orderBy("id").collect()]
    small, extra = divmod(10, n)
    expected = [s for s in range(n) for _ in range(small + (s < extra))]
    assert got == expected


@pytest.mark.parametrize("n", [2, 3, 4, 12])
def test_shard_files(spark, n):
    files = [(c, f"f{i:02d}") for c, count in (("a", 10), ("b", 3), ("c", 12)) for i in range(count)]
    df = spark.createDataFrame(files, "chunk string, path string")
    got = {(r["chunk"], r["path"]): r["shard"] for r in index.shard_files_floor(df, n, "chunk", ["path"], 20).collect()}
    shard = 20
    for chunk in "abc":
        paths = [p for c, p in files if c == chunk]
        step = len(paths) // n
        for j in range(n):
            part = paths[step * j:] if j == n - 1 else paths[step * j: step * (j + 1)]
            assert all(got[(chunk, p)] == shard for p in part)
            shard += 1
    only = df.where("chunk = 'a'")
    ceil = [r["shard"] for r in index.shard_files_ceil(only, n, ["path"]).orderBy("path").collect()]
    per = -(-10 // n)
    assert ceil == [i // per for i in range(10)]


def test_split_by_ratio_covers_everything(spark):
    ids = spark.range(1000)
    for ratios in ("969,30,1", "9999,1,0", "1,1,1", "0,0,5"):
        got = index.split_by_ratio(ids, ratios, ["id"])
        assert got.where("split is null").count() == 0
        assert got.count() == 1000
    splits = {r["split"]: r["count"] for r in index.split_by_ratio(ids, "9999,1,0", ["id"]).groupBy("split").count().collect()}
    assert splits == {"train": 1000}


def test_same_on_any_partitioning(spark, skewed):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in (1, 4, 32):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            df = index.shuffled_index(skewed.repartition(n), 9, ["id"], rows_per_bucket=200)
            results.append(rows_of(df.select("id", "position"), "position"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2]


def test_last_n_is_cut_before_the_shuffle(skewed):
    plan = index.last_n_per_group(skewed, ["k"], ["id"], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_spread_keys_are_cut_by_the_first_column(skewed):
    assert index._edges(skewed, ["id", "k"], 3000, 30)[0] == ["id"]
    assert index._edges(skewed, ["w", "id"], 3000, 5)[0] == ["w"]
    assert index._edges(skewed, ["w", "id"], 3000, 500)[0] == ["w", "id"]


@pytest.mark.parametrize("kind", ["double", "string", "timestamp", "date", "decimal(9,3)", "binary"])
@pytest.mark.parametrize("nulls", [False, True])
def test_any_type_of_key(spark, kind, nulls):
    n = (F.col("id") * 7919) % 1009
    value = {
        "double": F.when(n % 50 == 0, F.lit(float("nan"))).otherwise(n / 8 - 60),
        "string": F.concat(F.lit("é"), F.hex(n)),
        "timestamp": F.timestamp_micros(n * 1_234_567_891),
        "date": F.date_add(F.lit("2020-01-01"), n.cast("int")),
        "decimal(9,3)": n.cast("decimal(9,3)") / 8,
        "binary": F.encode(F.hex(n), "utf-8"),
    }[kind]
    df = spark.range(1000).select("id", value.alias("v"))
    if nulls:
        df = df.withColumn("v", F.when(F.col("id") % 10 != 0, F.col("v")))
    ordered = [r["id"] for r in df.orderBy("v", "id").collect()]
    got = index.global_index(df, ["v", "id"], rows_per_bucket=37)
    assert [r["id"] for r in got.orderBy("index").collect()] == ordered


def test_single_key_with_nulls(spark):
    df = spark.createDataFrame([(None,)] + [(i,) for i in range(100)], "id bigint")
    got = index.global_index(df, ["id"], rows_per_bucket=9).orderBy("index").collect()
    assert [r["id"] for r in got] == [None] + list(range(100))


def test_null_edges_are_left_out(spark):
    df = spark.createDataFrame([(None,), (1,), (5,), (9,)], "k bigint")
    found = df.select("k", index.edges_at_or_below(df, ["k"], ["{}", "{}", '{"k":5}', '{"k":7}']).alias("n"))
    assert {r["k"]: r["n"] for r in found.collect()} == {None: 0, 1: 0, 5: 1, 9: 2}
    assert df.select(index.edges_at_or_below(df, ["k"], ["{}"]).alias("n")).distinct().collect()[0]["n"] == 0


def test_empty_table(spark):
    empty = spark.range(0)
    assert index.global_index(empty, ["id"]).count() == 0
    assert index.shard_contiguous(empty, 3, ["id"]).count() == 0


@pytest.mark.parametrize("per_bucket", [7, 100_000])
def test_last_values(spark, per_bucket):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, None, None, f"v{i}"])) for i in range(200)] + [(i, None) for i in range(300, 400)]
    df = spark.createDataFrame(rows, "i int, v string").repartition(4)
    got = {r["i"]: r["last"] for r in index.last_values(df, ["i"], "v", rows_per_bucket=per_bucket).collect()}
    want, last = {}, None
    for i, v in rows:
        last = v or last
        want[i] = last
    assert got == want
    assert index.last_values(df.limit(0), ["i"], "v").count() == 0
    none = index.last_values(df.where("v is null"), ["i"], "v", rows_per_bucket=per_bucket)
    assert {r["last"] for r in none.collect()} == {None}


def test_running_total_of_nulls(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 2)], "i int, v long")
    got = index.running_total(df, ["i"], "v").orderBy("i").collect()
    assert [r["total_so_far"] for r in got] == [5, 5, 7]


def test_split_by_hash(spark):
    df = spark.range(4000)
    got = {r["id"]: r["split"] for r in index.split_by_hash(df, "60,40,0", 1, ["id"]).collect()}
    share = sum(s == "train" for s in got.values()) / 4000
    assert set(got.values()) == {"train", "validation"} and 0.57 < share < 0.63
    more = {r["id"]: r["split"] for r in index.split_by_hash(spark.range(8000).repartition(3), "60,40,0", 1, ["id"]).collect()}
    assert all(more[i] == s for i, s in got.items())
    with pytest.warns(UserWarning, match="larger"):
        index.split_by_hash(df, [1, 5], 1, ["id"], names=("a", "b"))
    with pytest.raises(ValueError):
        index.split_by_hash(df, "1,2", 1, ["id"])
