"""The k-th smallest key and medians against sorting, and plans that never bring all rows to one task."""

import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import audit, mixture, rows, selection

RNG = random.Random(5)


def table(spark):
    data = [(f"s{i % 5}" if i % 7 else None, RNG.choice([i, 3, -i * i, 10**17 + i])) for i in range(900)]
    data += [("hot", 42)] * 500 + [("alone", -5), ("empty", None), ("hot", None)]
    return data, spark.createDataFrame(data, "source string, size long").repartition(6)


def test_kth_key_of_each_group(spark):
    data, df = table(spark)
    groups = {s: sorted(v for g, v in data if g == s and v is not None) for s, _ in data}
    wanted = [(s, k) for s, values in groups.items() for k in (0, 1, 2, len(values) // 2, len(values), len(values) + 1)]
    asked = spark.createDataFrame(wanted, "source string, k long")
    keys = df.select("source", selection.sort_key(df, "size").alias("key"))
    got = {(r["source"], r["k"]): (int(r["key"], 16) - 2**63, r["below"]) for r in selection.kth_keys(keys, asked, ["source"]).collect()}
    want = {(s, k): (v[k - 1], sum(x < v[k - 1] for x in v)) for s, k in wanted for v in [groups[s]] if 1 <= k <= len(v)}
    assert got == want


@pytest.mark.parametrize("kind,values", [
    ("long", [-(2**63), 2**63 - 1, 0, -1, 1, 7, 7]),
    ("double", [float("-inf"), -1.5, -0.0, 0.0, 5e-324, 1.0, 1e300, float("inf"), float("nan")]),
    ("string", ["", "a", "aa", "b", "é", "z\x00"]),
])
def test_keys_sort_like_their_values(spark, kind, values):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    keys = {str(r["v"]): r["k"] for r in df.withColumn("k", selection.sort_key(df, "v")).collect()}
    order = [keys[str(r["v"])] for r in df.orderBy("v").collect()]
    assert order == sorted(order)
    if kind == "double":
        assert keys["-0.0"] == keys["0.0"]


def test_dates_and_times_sort_as_keys(spark):
    df = spark.sql("select timestamp'1969-01-01 00:00:00' + make_interval(0, 0, 0, 0, i) as t, date'1960-01-01' + cast(i * 300 as int) as d from (select explode(sequence(0, 40)) as i)")
    for c in ("t", "d"):
        found = df.withColumn("k", selection.sort_key(df, c)).orderBy(c).collect()
        assert [r["k"] for r in found] == sorted(r["k"] for r in found)


def test_medians(spark):
    data, df = table(spark)
    want = {}
    for s in {g for g, _ in data}:
        values = [v for g, v in data if g == s and v is not None]
        if values:
            want[s] = statistics.median(values)
    got = {r["source"]: r["median"] for r in selection.medians(df, "size", ["source"]).collect()}
    assert got == {s: pytest.approx(v) for s, v in want.items()}
    every = statistics.median(v for _, v in data if v is not None)
    assert selection.medians(df, "size").first()["median"] == pytest.approx(every)
    assert selection.medians(df.where("size is null"), "size").count() == 0
    floats = df.select((F.col("size") / 3.0).alias("size"))
    assert selection.medians(floats, "size").first()["median"] == pytest.approx(every / 3)


def plan(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_audit_reads_no_rows_in_one_task(spark):
    actual = spark.range(5000).selectExpr("concat('s', id % 3) as source", "id div 3 as shard", "id * id % 1009 as bytes")
    expected = actual.select("source", "shard")
    done = audit.shard_audit(expected, actual)
    middle = statistics.median(v for v in (i * i % 1009 for i in range(5000)) if v > 0)
    small = sum(0 < i * i % 1009 < middle * 0.5 for i in range(5000))
    assert done.where("status = 'small'").count() == small
    assert "SinglePartition" not in plan(done)


@pytest.mark.parametrize("n", [0, 1, 500, 1200, 5000])
def test_take_first_is_whole(spark, n):
    data = [(i % 300, f"t{i % 600}") for i in range(900)] + [(7, "copy")] * 400
    df = spark.createDataFrame(data, "id long, text string").repartition(5)
    got = [(r["id"], r["text"]) for r in rows.take_first(df, n, 3, ["id"]).collect()]
    full = [(r["id"], r["text"]) for r in rows.take_first(df, 0, 3, ["id"]).collect()]
    assert len(got) == (min(n, len(data)) or len(data)) and [g[0] for g in got] == [g[0] for g in full[: len(got)]]
    # What is taken is part of the table, with as many copies at most.
    for row in set(got):
        assert got.count(row) <= data.count(row)
    if n:
        assert not re.search(r"SinglePartition|GlobalLimit", plan(rows.take_first(df, n, 3, ["id"])))


def test_mix_moves_drawn_rows_only(spark):
    docs = spark.range(3000).selectExpr("id", "concat('s', id % 4) as source", "repeat('x', 50) as text")
    weights = spark.createDataFrame([("s0", 1.0), ("s1", 2.0), ("s2", 40.0), ("s3", 0.0)], "source string, weight double")
    mixed = mixture.mix(docs, weights, 1000, 5, ["id"], rows_per_bucket=100)
    text = plan(mixed)
    got = mixed.collect()
    assert len(got) == 1000 and {r["source"] for r in got} == {"s0", "s1", "s2"}
    order = {r["id"]: r["d"] for r in docs.selectExpr("id", "md5('5:' || id) as d").collect()}
    for s in range(3):
        own = sorted((r for r in got if r["source"] == f"s{s}" and r["copy"] == 0), key=lambda r: r["place"])
        every = sorted((i for i in range(3000) if i % 4 == s), key=order.get)
        assert [r["id"] for r in own] == every[: len(own)]
    # Below the exchange of rows with their texts, what is not drawn is gone.
    assert 0 <= text.rindex("Exchange hashpartitioning") < text.index("<= _end")
