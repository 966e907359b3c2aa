"""Tokens, packing and mixtures against plain Python."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import mixture, tokens


@pytest.fixture(scope="module")
def lists(spark):
    """Documents of very different lengths; one holds a third of all tokens."""
    rng = random.Random(8)
    rows = [(i, [rng.randrange(1000) for _ in range(rng.choice([0, 1, 2, 3, 17, 40]))]) for i in range(120)]
    rows.append((60_000, list(range(700))))
    return rows, spark.createDataFrame(rows, "id bigint, t array<bigint>").repartition(4)


@pytest.mark.parametrize("length", [1, 7, 64, 5000])
@pytest.mark.parametrize("plus_one", [True, False])
@pytest.mark.parametrize("per_bucket", [20, 100_000])
def test_pack_sequences(lists, length, plus_one, per_bucket):
    rows, df = lists
    flat = [x for _, t in sorted(rows) for x in t]
    extra = int(plus_one)
    expected = [flat[s: s + length + extra] for s in range(0, len(flat), length)]
    expected = {i: p for i, p in enumerate(expected) if len(p) == length + extra}
    got = tokens.pack_sequences(df, "t", length, ["id"], plus_one=plus_one, rows_per_bucket=per_bucket)
    assert {r["seq"]: r["tokens"] for r in got.collect()} == expected
    assert len(expected) == (len(flat) - extra) // length


def test_encode_both_ways(spark):
    rows = [(1, "a b b 12 c!"), (2, ""), (3, None), (4, "zz zz"), (5, "b\tb")]
    df = spark.createDataFrame(rows, "id bigint, text string").repartition(3)
    vocab = tokens.build_vocab(df, "text")
    ids = {r["token"]: r["id"] for r in vocab.collect()}
    assert ids["b"] == 0 and sorted(ids.values()) == list(range(len(ids)))
    some = vocab.where("token <> 'zz'")
    want = {1: [ids[x] for x in ("a", "b", "b", "1", "2", "c", "!")], 2: [], 3: [], 4: [-1, -1], 5: [0, 0]}
    for bound in (1000, 1):
        got = tokens.encode(df, "text", some, "id", max_rows=bound)
        assert {r["id"]: r["tokens"] for r in got.collect()} == want
    got = tokens.encode(df, "text", vocab.limit(0), "id", unknown=9)
    assert {r["id"]: r["tokens"] for r in got.collect()}[4] == [9, 9]


def test_known_vocabulary_is_not_shuffled(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    vocab = spark.createDataFrame([("the", 0)], "token string, id bigint")
    plan = tokens.encode(docs, "text", vocab, "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_throughput_without_time(spark):
    df = spark.createDataFrame([(3,), (4,)], "n int")
    assert tuple(tokens.throughput(df, "n", 0).first()) == (7, 0.0)
    assert tuple(tokens.throughput(df, "n", 2).first()) == (7, 3.5)


def test_files_and_caps(spark):
    rows = [(i, "a" if i % 3 else "b", 10) for i in range(30)]
    df = spark.createDataFrame(rows, "id bigint, s string, n bigint")
    files = tokens.files_by_max_tokens(df, "n", 100, ["id"], rows_per_bucket=4)
    assert [r["file"] for r in files.orderBy("id").collect()] == [i // 10 for i in range(30)]
    capped = tokens.skip_and_cap_tokens(df, "n", ["id"], ["s"], skip=20, cap=30, rows_per_bucket=4)
    kept = sorted(r["id"] for r in capped.collect())
    a, b = [i for i in range(30) if i % 3], [i for i in range(30) if i % 3 == 0]
    assert kept == sorted(a[2:5] + b[2:5])
    assert tokens.skip_and_cap_tokens(df, "n", ["id"], ["s"], skip=20).count() == 26


def test_mix_gives_exact_counts(spark):
    rows = [(i, "big" if i % 3 == 0 else f"s{i % 7}") for i in range(210)]
    docs = spark.createDataFrame(rows, "id bigint, source string")
    weights = spark.createDataFrame(
        [("big", 1.0), ("s1", 5.0), ("s2", 0.5), ("none", 1.0), ("s3", 0.0)], "source string, weight double"
    )
    quota = {r["source"]: r["quota"] for r in mixture.quotas(weights, 1001).collect()}
    assert sum(quota.values()) == 1001
    mixed = mixture.mix(docs, weights, 1001, 1, ["id"], rows_per_bucket=20)
    counts = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    # A source without rows has no share: the others make up the whole mixture.
    held = {r["source"]: r["quota"] for r in mixture.quotas(weights.where("source != 'none'"), 1001).collect()}
    assert sum(counts.values()) == 1001
    assert counts == {s: q for s, q in held.items() if q}
    # Copies of a source differ by one at most, and places are 0 … quota-1.
    for source in counts:
        places = sorted(r["place"] for r in mixed.where(F.col("source") == source).collect())
        assert places == list(range(counts[source]))
        times = [r["count"] for r in mixed.where(F.col("source") == source).groupBy("id").count().collect()]
        assert max(times) - min(times) <= 1


def test_interleave_follows_the_weights(spark):
    docs = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("source"))
    weights = spark.createDataFrame([("x", 3.0), ("y", 1.0)], "source string, weight double")
    mixed = mixture.mix(docs, weights, 80, 1, ["id"])
    shares = mixture.normalize_weights(weights)
    order = [r["source"] for r in mixture.interleave(mixed, shares).orderBy("position").collect()]
    for n in range(4, 80):
        assert abs(order[:n].count("x") - n * 0.75) <= 1.5


def test_published_shard_weights(spark):
    """Shares of an override over three shards, and the first-shard rule."""
    sizes = [1.45, 2.22, 2.11]
    shards = spark.createDataFrame(
        [("lhq_data", i, w) for i, w in enumerate(sizes)] + [("arxiv", 0, 5.27), ("arxiv", 1, 5.0), ("owm", 0, 2.42)]
        + [("ir_cpp", 0, 8.28), ("ir_cpp", 1, 1.0)],
        "source string, shard int, weight double",
    )
    scaled = {
        (r["source"], r["shard"]): r["weight"]
        for r in mixture.weights_override_scaled(shards, mixture.OVERRIDES_SMALL).collect()
    }
    assert ("arxiv", 0) not in scaled and scaled[("owm", 0)] == 2.42
    assert [scaled[("lhq_data", i)] for i in range(3)] == [0.25, 0.38, 0.37]
    first = {
        (r["source"], r["shard"]): r["weight"]
        for r in mixture.weights_override_first_shard(shards, mixture.OVERRIDES_LARGE).collect()
    }
    assert first[("ir_cpp", 0)] == 1.0 and ("ir_cpp", 1) not in first and first[("arxiv", 1)] == 5.0


def test_scaled_source_without_size(spark):
    shards = spark.createDataFrame([("a", 0, 0.0)], "source string, shard int, weight double")
    assert mixture.weights_override_scaled(shards, {"a": 2.0}).first()["weight"] is None


def test_manifest(spark):
    weights = spark.createDataFrame([("b", 0, 0.125, "/p/b"), ("a", 0, 1.0, "/p/a")], "source string, shard int, weight double, path string")
    assert mixture.render_manifest(weights, ["source", "shard"]).first()[0] == "1.00 /p/a 0.12 /p/b"
    lines = [r["text"] for r in mixture.manifest_lines(weights, ["source"]).orderBy("line").collect()]
    assert lines == ["- 1.00", "- /p/a", "- 0.12", "- /p/b"]
    with pytest.raises(ValueError):
        mixture.render_manifest(weights, ["source"], max_rows=1)


def test_sequences_stay_exact_beyond_one_bucket(spark):
    shuffled = spark.range(500).select(F.col("id"), F.array_repeat(F.col("id"), 3).alias("t"))
    packed = tokens.pack_sequences(shuffled, "t", 100, ["id"], rows_per_bucket=33)
    flat = [x for i in range(500) for x in [i] * 3]
    assert {r["seq"]: r["tokens"] for r in packed.collect()} == {s: flat[s * 100: s * 100 + 101] for s in range(14)}


def test_tokens_belong_to_texts(spark):
    """Both paths encode rows by their text: repeated and null ids, repeated, empty and null texts."""
    rows = [(1, "a b"), (1, "b"), (None, "a"), (2, "a b"), (3, ""), (4, None), (5, "z b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    vocab = spark.createDataFrame([("a", 0), ("b", 1)], "token string, id bigint")
    want = sorted([(1, [0, 1]), (1, [1]), (None, [0]), (2, [0, 1]), (3, []), (4, []), (5, [-1, 1])], key=str)
    for bound in (1, tokens.VOCAB_ROWS):
        got = tokens.encode(docs, "text", vocab, "doc_id", max_rows=bound).select("doc_id", "tokens")
        assert sorted(map(tuple, got.collect()), key=str) == want
    nothing = tokens.encode(docs, "text", vocab.limit(0), "doc_id").select("tokens").collect()
    assert sorted(len(r["tokens"]) for r in nothing) == [0, 0, 1, 1, 2, 2, 2]


def test_packing_moves_tokens_once(spark, lists):
    """The one exchange of tokens is by ranges; what travels on are pieces that do not fill a sample."""
    df = spark.createDataFrame(lists[0], "id bigint, t array<bigint>")
    packed = tokens.pack_sequences(df, "t", 8, ["id"], rows_per_bucket=20)
    packed.collect()
    plan = packed._jdf.queryExecution().toString().split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
    by_range = plan.count("Exchange hashpartitioning(_bucket")
    assert by_range - plan.count("ReusedExchange") <= 1
    for line in plan.split("\n"):
        if "Exchange " in line and "_bucket" not in line and "Broadcast" not in line and "Reused" not in line:
            assert "hashpartitioning(seq" in line or "SinglePartition" in line, line


def test_a_long_vocabulary_meets_distinct_tokens_only(spark, monkeypatch):
    """Nothing is written down by token, and blocks, copies and a replaced text column change no row."""
    written = []
    monkeypatch.setattr(tokens, "checkpointed", lambda df: written.append(df.count()) or df.checkpoint())
    monkeypatch.setattr(tokens, "BLOCK_BYTES", 3000, raising=False)
    spark.sparkContext.setCheckpointDir(spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp())
    rows = [(i % 7, " ".join(f"w{chr(97 + (i + j) % 11)}" for j in range(400)), i) for i in range(20)]
    rows += [rows[0]] * 30 + [(None, None, 1), (3, "", 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, other int").repartition(5)
    vocab = spark.createDataFrame([(f"w{chr(97 + i)}", i) for i in range(9)], "token string, id bigint")
    ids = {f"w{chr(97 + i)}": i for i in range(9)}
    want = sorted(((d, o, [ids.get(w, -1) for w in (t or "").split()]) for d, t, o in rows), key=str)
    got = tokens.encode(docs, "text", vocab, "doc_id", max_rows=1).select("doc_id", "other", "tokens")
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert sum(written) == 0
    same = tokens.encode(docs, "text", vocab, "doc_id", out="text", max_rows=1).select("doc_id", "other", "text")
    assert sorted(map(tuple, same.collect()), key=str) == want
