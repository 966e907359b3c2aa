"""Rows asked of coroutines, and scorers that keep state."""

import asyncio
import os
import sys
import threading
import time
from functools import partial

import duckdb
import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from corpusflow.functions import text as tx
from corpusflow.operators import async_rows, consistency

# Workers do not have the tests on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Service:
    """Counts what runs at once, fails where it is told to, and says who it is."""

    def __init__(self):
        self.now = self.most = 0
        self.seen = {}

    async def ask(self, row):
        i = row["i"]
        self.now += 1
        self.most = max(self.most, self.now)
        self.seen[i] = self.seen.get(i, 0) + 1
        try:
            await asyncio.sleep(0.03 if i % 10 == 0 else 0.001)
            if i % 9 == 4 and self.seen[i] <= 2:
                raise ValueError(f"row {i}")
            if i % 31 == 7:
                await asyncio.sleep(60)
            return {"twice": 2 * i, "most": self.most, "who": [os.getpid(), id(self) % 1000]}
        finally:
            self.now -= 1


ANSWER = "twice long, most int, who array<long>"


def test_answers_in_order(spark):
    df = spark.range(400).withColumnRenamed("id", "i").withColumn("text", F.lit("x")).repartition(3).sortWithinPartitions("i")
    df = df.withColumn("part", F.spark_partition_id())
    before = [(r["part"], r["i"]) for r in df.collect()]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # many requests over the borders of batches
    try:
        done = async_rows.map_async(df, Service, Service.ask, ANSWER, ["i"], in_flight=5, timeout=5, retries=2, wait=0.001)
        rows = done.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [(r["part"], r["i"]) for r in rows] == before
    assert max(r["most"] for r in rows if r["most"]) == 5
    for r in rows:
        if r["i"] % 31 == 7:
            assert r["twice"] is None and r["error"].startswith("TimeoutError") and r["attempts"] == 3
        else:
            assert r["twice"] == 2 * r["i"] and r["error"] is None
            assert r["attempts"] == (3 if r["i"] % 9 == 4 else 1)
    # One client per task.
    assert len({(r["part"], tuple(r["who"])) for r in rows if r["who"]}) == len({r["part"] for r in rows})


def test_failed_rows_stay(spark):
    async def refuse(client, row):
        raise KeyError(row["i"])

    df = spark.range(5).withColumnRenamed("id", "i")
    rows = async_rows.map_async(df, lambda: None, refuse, "a int", once=False).collect()
    assert [(r["i"], r["a"], r["error"], r["attempts"]) for r in rows] == [(i, None, f"KeyError: {i}", 1) for i in range(5)]
    assert async_rows.map_async(df.limit(0), lambda: None, refuse, "a int").count() == 0
    with pytest.raises(ValueError, match="exist"):
        async_rows.map_async(df, lambda: None, refuse, "i int")


def test_clients_are_opened_and_closed(spark, tmp_path):
    class Client:
        async def __aenter__(self):
            (tmp_path / f"open-{id(self)}-{time.time_ns()}").touch()
            return "client"

        async def __aexit__(self, *problem):
            (tmp_path / f"closed-{id(self)}-{time.time_ns()}").touch()

    async def ask(client, row):
        return {"said": client}

    df = spark.range(0, 40, 1, 4)
    done = async_rows.map_async(df, Client, ask, "said string")
    assert {r["said"] for r in done.collect()} == {"client"}
    assert done.count() == 40  # the answers were written down: nobody is asked again
    names = [p.name.split("-")[0] for p in tmp_path.iterdir()]
    assert names.count("open") == names.count("closed") == 4


def test_requests_go_on_while_the_task_waits():
    """A request does not time out because the next rows come late."""
    stream = async_rows.Stream(lambda: None, lambda c, row: asyncio.sleep(0.05, {"a": row["i"]}), 2, 0.2, 0, 0)
    out = [list(stream.put({"i": i})) for i in range(3)]
    time.sleep(0.5)
    got = [x for part in out for x in part] + list(stream.done(0))
    stream.close()
    assert got == [({"a": i}, None, 1) for i in range(3)]
    assert not any(t.name.startswith("asyncio") for t in threading.enumerate())


def test_completions(spark):
    async def generate(client, chat):
        return f"{chat}!  <|endoftext|>"

    df = spark.createDataFrame([(1, "a b"), (2, None)], "i int, prompt string")
    rows = async_rows.complete(df, lambda: None, generate).orderBy("i").collect()
    assert rows[0]["completion"] == "<s>[INST]  a b [/INST]!" and rows[0]["token_length"] == 10
    assert rows[1]["completion"] is None and rows[1]["token_length"] is None and rows[1]["error"] is None


class Counting:
    """Writes a file when it is made, which stands for loading a model."""

    def __init__(self, folder):
        time.sleep(0.05)
        open(os.path.join(folder, f"{os.getpid()}-{time.time_ns()}"), "w").close()
        self.calls = 0

    def predict(self, sentences, passages):
        self.calls += 1
        return np.array([[float(len(s) % 7 + len(p) % 5) for p in passages] for s in sentences])


def test_scorer_is_made_once_per_worker(spark, tmp_path):
    sents = [(i % 11 if i % 2 else 0, i, "s" * (i % 23 + 1)) for i in range(300)]
    samples = [(k, j, "p" * (k + 3 * j) + "\n") for k in range(11) for j in range(9)]
    s = spark.createDataFrame(sents, "k bigint, sent_idx int, sentence string").repartition(8)
    p = spark.createDataFrame(samples, "k bigint, j bigint, text string")
    want = {
        (k, i): sum(len(x) % 7 + len(t) % 5 for kk, _, t in samples if kk == k) / 9 for k, i, x in sents
    }
    done = consistency.score_pairs(
        s, p, "k", None, "j", chunk=2, sentences_per_block=10, hot_rows=20, make_scorer=partial(Counting, str(tmp_path))
    )
    for _ in range(2):
        assert {(r["k"], r["sent_idx"]): pytest.approx(r["score"]) for r in done.collect()} == want
    workers = [f.name.split("-")[0] for f in tmp_path.iterdir()]
    assert len(workers) == len(set(workers)) <= 16


def test_a_passage_crosses_once_per_block_of_sentences(spark):
    """Blocks meet, not sentences and passages."""
    s = spark.createDataFrame([(1, i, f"sentence {i}") for i in range(100)], "k bigint, sent_idx int, sentence string")
    p = spark.createDataFrame([(1, j, f"passage {j}") for j in range(60)], "k bigint, j bigint, text string")
    seen = []

    class Noting:
        def predict(self, sentences, passages):
            assert len(sentences) <= 25 and len(passages) <= 20
            return np.ones((len(sentences), len(passages)))

    done = consistency.score_pairs(s, p, "k", None, "j", chunk=20, make_scorer=Noting, sentences_per_block=25)
    assert [r["score"] for r in done.collect()] == [1.0] * 100 and not seen
    with pytest.raises(ValueError):
        consistency.score_pairs(s, p, "k", None, "j")


def test_answers_as_scores():
    asked = []

    def answer(question):
        asked.append(question)
        return {"a": " YES it is", "b": "No.", "c": "perhaps"}[question.split("Sentence: ")[1][0]]

    scorer = consistency.AnswerScorer(answer, tx.SUPPORT_TEMPLATE_STEPS)
    assert scorer.predict(["a", "b", "c"], ["{sentence}", "y"]).tolist() == [[0, 0], [1, 1], [0.5, 0.5]]
    assert asked[0].startswith("Context: {sentence}\n\nSentence: a\n\n") and "step by step" in asked[0]


def test_samples_are_asked_for_where_there_are_none(spark):
    prompts = spark.createDataFrame([(1, "x"), (2, "y"), (3, "bad")], "k int, prompt string")
    samples = spark.createDataFrame([(1, 0, "given")], "k int, sample_idx int, text string")

    async def generate(client, prompt):
        if prompt == "bad":
            raise ValueError(prompt)
        return f"{prompt}\nmade"

    got = consistency.with_samples_asked_for(prompts, samples, "k", "prompt", 2, lambda: None, generate)
    assert sorted(map(tuple, got.collect())) == [(1, 0, "given"), (2, 0, "y made"), (2, 1, "y made")]


def test_equal_prompts_are_counted_by_row(spark, tmp_path):
    """Rows with one prompt, and rows with one key, each have attempts of their own, as in the SQL."""
    from compare import compare

    from corpusflow.plans.queries import ORACLES, QUERIES

    said = [(i % 40, i % 3, "user", "ab" * (i % 25)) for i in range(300)] + [(1, 1, "user", None)] * 3
    folder = str(tmp_path / "sf")
    spark.createDataFrame(said, "conv_id bigint, turn bigint, role string, text string").coalesce(1).write.parquet(f"{folder}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{folder}/conversations.parquet/*.parquet')")
    assert compare(spark, con, folder, QUERIES["complete"], ORACLES["complete"])[:2] == ("equal", 303)
