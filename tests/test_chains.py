"""Sources, sinks, generations, consistency, audits and arriving files."""

import os
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusflow.functions.numbers import round_half_even
from corpusflow.functions.text import normalize_newlines, truncate_at_stop
from corpusflow.operators import audit, consistency, decontam, generations, grid, rows
from corpusflow.session import checkpoint_dir, scratch_path
from corpusflow.sources import readers, sinks
from corpusflow.streaming.arriving import process_arrived


def test_sharded_json_sources(spark, tmp_path):
    docs = spark.range(10).select("id", F.concat(F.lit("t"), F.col("id").cast("string")).alias("full_text"))
    for i in range(2):
        part = docs.where(F.col("id") % 2 == i)
        sinks.write_jsonl(part, f"{tmp_path}/issues-{i:05d}-of-00002.jsonl")
    sources = readers.sharded_sources(f"{tmp_path}/issues", 2, "issues", "full_text")
    got = readers.read_sources(spark, sources)
    assert sorted(map(tuple, got.collect())) == sorted((f"issues_{i % 2}", f"t{i}") for i in range(10))
    catalog = readers.source_catalog(spark, [sources, [readers.Source("c", "/x", "content", "data/c")]], "/out/")
    assert [tuple(r) for r in catalog.collect()][-1] == ("c", "/x", "data/c", "/out/c", "content")


def test_subset_is_pruned(spark, tmp_path):
    spark.range(10).withColumn("lang", F.when(F.col("id") < 5, "a").otherwise("b")).write.partitionBy("lang").parquet(
        f"{tmp_path}/d"
    )
    subset = readers.read_subset(spark, f"{tmp_path}/d", "a")
    assert subset.count() == 5
    assert "PartitionFilters: [isnotnull(lang" in subset._jdf.queryExecution().executedPlan().toString()


def test_one_source_per_folder(spark, tmp_path):
    for lang in ("c", "ada"):
        spark.createDataFrame([(f"text in {lang}",)], "content string").write.parquet(f"{tmp_path}/data/{lang}")
    sources = readers.folder_sources(spark, f"{tmp_path}/data", "content")
    assert [s.name for s in sources] == ["ada", "c"]
    got = readers.read_sources(spark, sources)
    assert sorted(map(tuple, got.collect())) == [("ada", "text in ada"), ("c", "text in c")]


def test_score_filter_is_pushed_down(spark, sf):
    plan = rows.filter_min_score(spark.read.parquet(f"{sf}/labels.parquet"), "quality", 4)
    assert "GreaterThanOrEqual(quality,4)" in plan._jdf.queryExecution().executedPlan().toString()


def test_csv_with_blank_cells(spark, tmp_path):
    path = tmp_path / "w.csv"
    path.write_text("data_source,n_shards,total,,difference\nissues,5,22.11,,3.06\nir_cpp,1,16.55,,\n")
    schema = "data_source string, n_shards int, total double, blank string, difference double"
    got = [tuple(r) for r in readers.read_csv_table(spark, str(path), schema).collect()]
    assert got == [("issues", 5, 22.11, None, 3.06), ("ir_cpp", 1, 16.55, None, None)]


def test_list_files_and_first_file(spark, tmp_path):
    for folder, names in {"code_0": ["b.json", "a.json"], "code_1": ["x.txt"]}.items():
        os.makedirs(tmp_path / folder)
        for name in names:
            (tmp_path / folder / name).write_text("12345")
    files = readers.list_files(spark, str(tmp_path))
    first = audit.first_file_per_folder(files).collect()
    assert [(r["folder"], r["path"].split("/")[-1]) for r in first] == [("code_0", "a.json")]
    assert [r["folder"] for r in audit.folders_without_file(files).collect()] == ["code_1"]
    assert files.agg(F.sum("bytes")).first()[0] == 15


def test_hot_shard_is_written_by_several_tasks(spark, tmp_path):
    docs = spark.range(0, 9000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 5).cast("string"))).alias("shard"))
    # Tiny partitions would be merged again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        sinks.write_jsonl(docs, f"{tmp_path}/out", shard="shard", order=["id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = [f for f in os.listdir(f"{tmp_path}/out/shard=hot") if f.startswith("part")]
    assert len(parts) > 1
    assert spark.read.schema("id bigint, shard string").json(f"{tmp_path}/out").count() == 9000


def test_manifest_file(spark, tmp_path):
    lines = spark.createDataFrame([(1, "- /p"), (0, "- 1.00")], "line bigint, text string")
    sinks.write_manifest(lines, f"{tmp_path}/m")
    assert [r[0] for r in spark.read.text(f"{tmp_path}/m").collect()] == ["- 1.00", "- /p"]


class FakeContext:
    def __init__(self, master, current=None):
        self.master, self.current = master, current

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = path


class FakeSession:
    def __init__(self, master, configured=None, current=None):
        self.sparkContext = FakeContext(master, current)
        self.conf = {"spark.checkpoint.dir": configured} if configured else {}


def test_checkpoint_dir_of_the_session_wins():
    assert checkpoint_dir(FakeSession("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert checkpoint_dir(FakeSession("yarn", "hdfs:///shared", "hdfs:///other")) == "hdfs:///shared"
    assert scratch_path(FakeSession("yarn", "hdfs:///shared/"), "x").startswith("hdfs:///shared/corpusflow/x-")
    assert checkpoint_dir(FakeSession("yarn", None, "hdfs:///other")) == "hdfs:///other"
    with pytest.raises(RuntimeError):
        checkpoint_dir(FakeSession("yarn"))


def test_align_needs_enough_partners(spark):
    a, b = spark.range(3).toDF("x"), spark.range(5).toDF("y")
    assert [tuple(r) for r in generations.align_by_position(a, b, ["x"], ["y"]).orderBy("x").collect()] == [
        (0, 0, 0), (1, 1, 1), (2, 2, 2)
    ]
    with pytest.raises(IndexError):
        generations.align_by_position(b, a, ["y"], ["x"])


def test_long_chats_are_one_row(spark):
    turns = [(1, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(25)] + [(2, 0, "user", "u")]
    df = spark.createDataFrame(turns, "conv bigint, turn bigint, role string, text string").repartition(4)
    whole = {r["conv"]: r["prompt"] for r in generations.render_chat(df, ["conv"]).collect()}
    blocks = generations.render_chat(df, ["conv"], block_size=4).collect()
    assert len(blocks) == 2 and {r["conv"]: r["prompt"] for r in blocks} == whole
    assert whole[1].startswith("<s>[INST]  t0 [/INST]t1</s> [INST]  t2 ")
    assert whole[2] == "<s>[INST]  u [/INST]"


def test_support_scores_like_pairs(spark):
    """The grouped form equals scoring every pair; one key holds a third of the sentences."""

    def words(x):
        return set(re.findall(r"\w+", x.lower()))

    sents = [(0 if i % 3 == 0 else i % 7 + 1, i, f"word{i % 5} common other{i % 11} ok") for i in range(90)]
    samples = [(k, j, f"common word{j} and other{k} here") for k in range(8) for j in range(4)]
    s = spark.createDataFrame(sents, "k bigint, sent_idx int, sentence string")
    p = spark.createDataFrame(samples, "k bigint, j bigint, text string")
    expected = {}
    for k, i, sentence in sents:
        w = words(sentence)
        scores = [1 - len(w & words(t)) / len(w) for kk, _, t in samples if kk == k]
        expected[(k, i)] = pytest.approx(sum(scores) / len(scores))
    for hot in (10, 1_000_000):
        grouped = consistency.support_scores(s, p, "k", hot_rows=hot)
        assert {(r["k"], r["sent_idx"]): r["score"] for r in grouped.collect()} == expected

    def scorer(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([1 - len(words(x) & words(y)) / len(words(x)) for x, y in zip(a, b)], index=a.index)

    for chunk in (1, 3, 100):
        pairs = consistency.score_pairs(s, p, "k", scorer, "j", chunk=chunk, hot_rows=10 * chunk)
        assert {(r["k"], r["sent_idx"]): r["score"] for r in pairs.collect()} == expected


def test_extract_first_of_a_log(spark):
    log = [(1, "starting"), (2, " port: 4242 open"), (3, ' "hostname": "n1"'), (4, " port: 9 again")]
    df = spark.createDataFrame(log, "line int, text string")
    assert audit.extract_first(df, r" port: (\d+)", "text", ["line"]).first()["value"] == "4242"
    assert audit.extract_first(df, r'"hostname": "([^"]*)"', "text", ["line"]).first()["value"] == "n1"


def test_audit(spark):
    expected = spark.createDataFrame([("code", i) for i in range(5)], "source string, shard int")
    actual = spark.createDataFrame([("code", 0, 100), ("code", 1, 110), ("code", 2, 20), ("code", 3, 0)], "source string, shard int, bytes bigint")
    got = {r["shard"]: r["status"] for r in audit.shard_audit(expected, actual).collect()}
    assert got == {0: "ok", 1: "ok", 2: "small", 3: "Empty", 4: "Empty"}
    assert [r["shard"] for r in audit.missing_shards(expected, actual, ["source", "shard"]).collect()] == [4]


def test_stage_of_step(spark):
    stages = spark.createDataFrame([("b", 100), ("a", 1)], "name string, start_training_step bigint")
    steps = spark.createDataFrame([(s,) for s in (0, 1, 99, 100, 5000)], "step bigint")
    got = {r["step"]: r["name"] for r in grid.stage_of_step(steps, stages).collect()}
    assert got == {0: None, 1: "a", 99: "a", 100: "b", 5000: "b"}


def test_stages_of_any_number(spark):
    """100,000 stages; a third of the steps are one number; ties, steps before all stages, and nulls."""
    stages = spark.range(100_000).selectExpr("concat('n', id) as name", "id * 3 + 10 as start_training_step")
    stages = stages.unionByName(spark.createDataFrame([("zz", 13), ("a", 13), ("never", None)], "name string, start_training_step long"))
    steps = spark.range(30_000).selectExpr("case when id % 3 = 0 then 777 when id = 1 then null else id * 11 - 50 end as step", "id as other")
    got = grid.stage_of_step(steps, stages, rows_per_bucket=5000)
    assert got.columns == ["step", "other", "start_training_step", "name"]
    rows = got.collect()
    assert sorted(r["other"] for r in rows) == list(range(30_000))
    for r in rows:
        s = r["step"]
        if s is None or s < 10:
            assert r["name"] is None and r["start_training_step"] is None
        else:
            i = min((s - 10) // 3, 99_999)
            assert r["start_training_step"] == i * 3 + 10 and r["name"] == ("zz" if i == 1 else f"n{i}")


def test_few_stages_agree_with_many(spark):
    stages = spark.createDataFrame([("b", 100, 1), ("c", 100, 2), ("a", 1, 3), (None, 5, 4)], "name string, start_training_step bigint, x int")
    steps = spark.createDataFrame([(s,) for s in (0, 1, 4, 5, 99, 100, 5000, None, 100)], "step bigint")
    few, many = (grid.stage_of_step(steps, stages, in_place=n) for n in (10, 0))
    assert few.columns == many.columns
    rows = sorted(map(str, few.collect()))
    assert rows == sorted(map(str, many.collect())) and len(rows) == 9
    none = grid.stage_of_step(steps, stages.limit(0))
    assert {r["name"] for r in none.collect()} == {None}


def test_source_difference(spark):
    """Published totals: tokens are half the gigabytes, the difference is absolute."""
    table = [("pull_requests", 39.07, 19.54, 20.0, 0.46), ("issues", 22.11, 11.06, 8.0, 3.06), ("arxiv", 60.52, 30.26, 30.2, 0.06)]
    df = spark.createDataFrame(table, "s string, gb double, tokens double, expected double, difference double")
    assert df.where(F.abs(F.col("gb") / 2 - F.col("tokens")) > 0.0051).count() == 0
    assert df.where(round_half_even(F.abs(F.col("expected") - F.col("tokens"))) != F.col("difference")).count() == 0


def test_arriving_files(spark, tmp_path):
    """Row-wise operators on a stream; each file once."""
    strings = spark.createDataFrame([("Secret Answer",)], "string string")
    schema = "doc_id bigint, text string, score int"

    def transform(df):
        scored = rows.filter_min_score(df, "score", 2)
        clean = decontam.decontaminate(scored, strings, "text", "doc_id")
        return rows.strip_non_empty(clean, "text").select(
            "doc_id", normalize_newlines(truncate_at_stop("text", ["STOP"])).alias("text")
        )

    folder, out, progress = (f"{tmp_path}/{x}" for x in ("in", "out", "progress"))
    first = [(1, " a\nb STOP c", 3), (2, "the secret answer", 3), (3, "low", 1), (4, "  ", 5)]
    spark.createDataFrame(first, schema).write.parquet(f"{folder}/1")
    process_arrived(spark, f"{folder}/*", schema, transform, out, progress)
    assert [tuple(r) for r in spark.read.parquet(out).collect()] == [(1, "a b ")]
    spark.createDataFrame([(5, "new", 2)], schema).write.parquet(f"{folder}/2")
    process_arrived(spark, f"{folder}/*", schema, transform, out, progress)
    assert sorted(r["doc_id"] for r in spark.read.parquet(out).collect()) == [1, 5]


def test_rows(spark):
    df = spark.createDataFrame([("10000_x",), ("500_x",), ("0_x",), ("x_10000",), ("20000_x",)], "name string")
    got = [r["iteration"] for r in rows.iteration_filter(df, "name", 10_000).orderBy("iteration").collect()]
    assert got == [10_000, 20_000]
    assert [r["name"] for r in rows.sort_numeric(spark.createDataFrame([("a10",), ("a9",)], "name string"), "name").collect()] == ["a9", "a10"]
    ids = spark.range(100)
    assert rows.take_first(ids, -1, 1, ["id"]).count() == 100
    assert rows.take_first(ids, 7, 1, ["id"]).count() == 7
    shards = spark.createDataFrame([("a", 2), ("b", 0), ("c", None)], "s string, n int")
    assert [tuple(r) for r in rows.expand_shards(shards, "n").select("s", "shard").collect()] == [("a", 0), ("a", 1)]


def test_1200_turns_and_turns_from_one(spark):
    """A chat beyond one block is one row; the start mark and the preamble do not ask for turn 0."""
    long = [(1, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(1200)]
    turns = [*long, (2, 1, "user", "hi"), (2, 2, "assistant", "yo"), (None, 5, "user", "n")]
    df = spark.createDataFrame(turns, "conv bigint, turn bigint, role string, text string").repartition(5)
    got = {r["conv"]: r["prompt"] for r in generations.render_chat(df, ["conv"], preamble="Be.").collect()}
    assert got[2] == "<s>[INST] Be.\n hi [/INST]yo</s> "
    assert got[None] == "<s>[INST] Be.\n n [/INST]"
    assert got[1].count("<s>") == 1 and got[1].count("Be.") == 1
    assert re.findall(r"t(\d+)", got[1]) == [str(i) for i in range(1200)]
    nested = generations.nest(df, ["conv"], "turn", F.col("text"), "items").collect()
    assert sorted(len(r["items"]) for r in nested) == [1, 2, 1200]
