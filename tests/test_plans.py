"""What the physical plans must not hold."""

import pytest

import __spark_entry__ as entry
from corpusflow.operators import decontam, rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cross_joins(spark, sf):
    found = {}
    for name, query in entry.queries().items():
        text = plan(query(spark, sf))
        bad = [node for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython") if node in text]
        if bad:
            found[name] = bad
    assert not found


def test_decontamination_reads_each_text_once(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    strings = spark.read.parquet(f"{sf}/benchmark.parquet").withColumnRenamed("text", "string")
    clean = decontam.decontaminate(docs, strings, "text", "doc_id").select("doc_id")
    text = plan(clean)
    assert text.count("ArrowEvalPython") == 1 and text.count("FileScan") == 1 and "Exchange" not in text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_only_needed_columns_are_read(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sampled = rows.sample_rate(docs, 0.1, 1, ["doc_id"]).select("doc_id", "source")
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan(sampled)


@pytest.mark.parametrize("n", [5, 200])
def test_take_first_sorts_few_rows(spark, n):
    ids = spark.range(20_000)
    got = [r["id"] for r in rows.take_first(ids, n, 3, ["id"]).collect()]
    assert got == [r["id"] for r in rows.take_first(ids, -1, 3, ["id"]).limit(n).collect()]
    assert "Filter" in plan(rows.take_first(ids, n, 3, ["id"]))
