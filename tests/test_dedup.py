"""Signatures, clusters and removal against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusflow.operators import dedup, ngrams


def brute_signature(text, hashes):
    words = re.findall(r"[^\W]+", text.lower())
    if not words:
        return []
    h = [int(hashlib.md5(w.encode()).hexdigest()[:15], 16) for w in words]
    grams = [h[i:i + 5] for i in range(max(1, len(h) - 4))]
    p, shingles = ngrams.PRIME, set()
    for g in grams:
        total = 0
        for x in g:
            total = (total * ngrams.BASE + x) % p
        shingles.add(total)
    perms = [dedup.permutation(k) for k in range(hashes)]
    return [min((x * a + b) % p for x in shingles) for a, b in perms]


def test_arithmetic_modulo_the_prime():
    rng, p = random.Random(4), ngrams.PRIME
    edges = [0, 1, 2, (1 << 31) - 1, 1 << 31, 1 << 60, p - 2, p - 1]
    values = edges + [rng.randrange(p) for _ in range(500)]
    x = np.array(values, dtype=np.uint64)
    high, low = x >> np.uint64(ngrams.LIMB), x & np.uint64((1 << ngrams.LIMB) - 1)
    for factor in edges + [rng.randrange(p) for _ in range(50)]:
        for plus in (0, 5, p - 1):
            out, spare, mid = (np.empty_like(x) for _ in range(3))
            ngrams.times_plus(high, low, factor, plus, out, spare, mid)
            assert out.tolist() == [(v * factor + plus) % p for v in values]


@pytest.mark.parametrize("block", [1, 7, 500, 1 << 21])
def test_blocks(block):
    rng = random.Random(6)
    rows = [["w%d" % rng.randrange(9) for _ in range(rng.choice([0, 1, 4, 5, 6, 40]))] for _ in range(60)]
    lists = pa.array([["x"]] + rows, pa.list_(pa.string())).slice(1)
    parts = list(ngrams.blocks(lists, block))
    assert [x for part in parts for x in part.to_pylist()] == rows
    for part in parts:
        assert len(part) == 1 or sum(map(len, part.to_pylist())) <= block


def test_signature(spark):
    rng = random.Random(1)
    texts = ["", "one", "one two three four", "!!!", None, "Ünïcode wörds hier, und_mehr 42"]
    texts += [" ".join(rng.choices("abcdefghij", k=rng.randrange(0, 300))) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").repartition(3)
    got = {r["id"]: r["signature"] for r in dedup.minhash_signature(df, "text", "id", bands=2, rows=3).collect()}
    for i, text in enumerate(texts):
        assert got[i] == brute_signature(text or "", 6), i


def brute_components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in list(parent) if find(x) != x}


def shapes():
    rng = random.Random(2)
    yield "nothing", []
    yield "loops", [(1, 1), (2, 2)]
    yield "chain", [(i, i + 1) for i in range(60)]
    path = rng.sample(range(80), 80)
    yield "shuffled chain", list(zip(path, path[1:]))
    yield "hub with the largest id", [(1000, i) for i in range(200)]
    yield "random", [(rng.randrange(150), rng.randrange(150)) for _ in range(110)]
    yield "hub and chains", [(0, i) for i in range(1, 100)] + [(i, i + 100) for i in range(1, 100)]


@pytest.mark.parametrize("name,edges", list(shapes()), ids=[s[0] for s in shapes()])
@pytest.mark.parametrize("hot_rows", [5, 1_000_000])
def test_clusters(spark, name, edges, hot_rows):
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r["id"]: r["cluster"] for r in dedup.duplicate_clusters(df, hot_rows=hot_rows).collect()}
    assert got == brute_components(edges)


def test_rounds_that_do_not_suffice_raise(spark):
    chain = spark.range(100).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    with pytest.raises(RuntimeError):
        dedup.duplicate_clusters(chain, max_rounds=1)


def test_copies_collapse_to_the_smallest_id(spark):
    """A third of all documents is one text."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(5000)]
    texts = [" ".join(rng.choices(words, k=60)) for _ in range(200)]
    rows = [(i, texts[i]) for i in range(200)] + [(200 + i, "The SAME, text. of all " * 5) for i in range(100)]
    rows += [(300, ""), (301, ""), (302, None)]
    df = spark.createDataFrame(rows, "id bigint, text string")
    kept = {r["id"] for r in dedup.keep_one_per_cluster(df, "text", "id", bands=4, rows=4).collect()}
    assert kept == set(range(201)) | {300, 301, 302}
    bands = dedup.document_bands(df, "text", "id")
    edges = dedup.band_edges(dedup.band_keys(bands, "id"), "id", hot_rows=10)
    # A star, not pairs: one edge per copy and band, the bands being equal.
    assert edges.count() == 99


def test_same_on_any_partitioning(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before, results = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (1, 4, 32):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            flagged = dedup.flag_duplicates(docs.repartition(n), "text", "doc_id")
            results.append(sorted((r["doc_id"], r["keep"]) for r in flagged.select("doc_id", "keep").collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2]
    assert len(results[0]) == docs.count()
    # Exact copies always collapse.
    keep = dict(results[0])
    copies = docs.groupBy("text").agg(F.collect_list("doc_id").alias("ids")).where("size(ids) > 1").collect()
    assert copies
    for r in copies:
        assert sum(keep[i] for i in r["ids"]) <= 1


def test_texts_are_not_shuffled(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = dedup.minhash_signature(docs, "text", "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_keys_of_documents_like_no_other_stay_where_they_are(spark):
    signatures = spark.range(3000).select("id", F.transform(F.sequence(F.lit(0), F.lit(111)), lambda i: F.col("id") * 1000 + i).alias("signature"))
    twins = spark.range(3000, 3040).select("id", F.transform(F.sequence(F.lit(0), F.lit(111)), lambda i: (F.col("id") % 20) * -1000 - 200 - i).alias("signature"))
    none = spark.range(5000, 5003).select("id", F.array().cast("array<bigint>").alias("signature"))
    arrays = dedup.band_arrays(signatures.unionByName(twins).unionByName(none), "id")
    buckets = dedup.repeated_buckets(dedup.band_keys(arrays, "id"), "id")
    moved = dedup.keys_in_buckets(arrays, buckets, "id")
    assert moved.where("id >= 3000").count() == 40 * 14
    assert moved.where("id < 3000").count() < 3000 * 14 / 8
    got = {r["id"]: r["cluster"] for r in dedup.near_duplicates(arrays, "id").collect()}
    plain = dedup.duplicate_clusters(dedup.band_edges(dedup.band_keys(arrays, "id"), "id"), "id", "hub")
    assert got == {r["id"]: r["cluster"] for r in plain.collect()} and len(got) == 20
    full = dedup.keys_in_buckets(arrays, buckets, "id", most_bits=15)
    assert full.where("id >= 3000").count() == 40 * 14


def test_half_a_key_makes_no_link(spark):
    """Keys that agree in 64 bits and differ in the others are different bands."""
    rows = [(1, [(5, 1)]), (2, [(5, 2)]), (3, [(5, 1)]), (4, [(6, 1)])]
    arrays = spark.createDataFrame(rows, "id long, keys array<struct<a:bigint,b:bigint>>")
    assert [tuple(r) for r in dedup.near_duplicates(arrays, "id").collect()] == [(3, 1)]
