"""Decontamination by both ways against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import decontam, substrings
from corpusflow.operators.sizing import lookup, skew_join


def contaminated(docs, strings):
    lowered = [s.lower() for s in strings if s]
    return {i for i, t in docs if t is not None and any(s in t.lower() for s in lowered)}


@pytest.fixture(scope="module")
def fixture():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(30)] + ["Straße", "été", "x.y", "a", "b"]
    strings = [" ".join(rng.choices(vocab, k=rng.choice([1, 2, 3, 4, 5, 9, 14]))) for _ in range(60)]
    strings += ["ONE two\nthree  four five", "zz", "tail of", "", "q r s"]
    docs = []
    for i in range(300):
        words = rng.choices(vocab, k=rng.randrange(0, 120))
        text = " ".join(words)
        if i % 3 == 0:
            # A third of the documents hold one and the same string, inside longer words.
            text += " pre" + strings[10] + "post " + text
        if i % 7 == 0:
            text = text.upper() + "\n" + rng.choice(strings) + "x"
        docs.append((i, text))
    docs += [(1000, None), (1001, ""), (1002, "one TWO\nthree  four five!"), (1003, "one two three four five")]
    # Leave out the shortest strings so that not every document is hit.
    strings = [s for s in strings if len(s) > 3 or s == ""]
    return docs, strings


@pytest.mark.parametrize("max_bytes", [1 << 20, 200])
def test_decontaminate(spark, fixture, max_bytes):
    docs, strings = fixture
    df = spark.createDataFrame(docs, "id bigint, text string").repartition(6)
    listed = spark.createDataFrame([(s,) for s in strings], "string string")
    kept = {r["id"] for r in decontam.decontaminate(df, listed, "text", "id", max_bytes=max_bytes).collect()}
    bad = contaminated(docs, strings)
    assert 0 < len(bad) < len(docs)
    assert kept == {i for i, _ in docs} - bad


@pytest.mark.parametrize("max_bytes", [1 << 20, 200])
def test_first_hit(spark, fixture, max_bytes):
    docs, strings = fixture
    df = spark.createDataFrame(docs, "id bigint, text string")
    listed = spark.createDataFrame(list(enumerate(strings)), "ord bigint, string string")
    got = decontam.contamination_hits(df, listed, "text", "ord", max_bytes=max_bytes)
    expected = {}
    for i, text in docs:
        hits = [n for n, s in enumerate(strings) if s and text is not None and s.lower() in text.lower()]
        if hits:
            expected[i] = hits[0]
    assert {r["id"]: r["hit_ord"] for r in got.collect()} == expected


def test_empty_lists(spark):
    df = spark.createDataFrame([(1, "a")], "id bigint, text string")
    none = spark.createDataFrame([], "ord bigint, string string")
    assert decontam.decontaminate(df, none, "text", "id").count() == 1
    assert decontam.decontaminate_anchored(df, none, "text", "id").count() == 1
    assert decontam.contamination_hits(df, none, "text", "ord").count() == 0


def test_report_of_nothing(spark):
    flagged = spark.createDataFrame([], "keep boolean")
    assert tuple(decontam.removal_report(flagged).first()) == (0, 0, None)


def test_benchmark_strings(spark):
    bench = spark.createDataFrame([("  return x + y\n",), (" ",), (None,), (" real answer ",)], "s string")
    got = decontam.benchmark_strings(bench, "s", ["return x + y"], "solutions").collect()
    assert [tuple(r) for r in got] == [("solutions", "real answer")]


def test_lookup_with_and_without_broadcast(spark):
    left = spark.range(300).select((F.col("id") % 7).alias("k"), "id")
    table = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        plain = sorted(map(repr, left.join(table, "k", how).collect()))
        assert sorted(map(repr, lookup(left, table, ["k"], how).collect())) == plain
        assert sorted(map(repr, lookup(left, table, ["k"], how, max_rows=2).collect())) == plain


def test_skew_join_splits_hot_keys(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    right = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    left = left.unionByName(spark.range(5).select(F.lit(None).cast("bigint").alias("k"), "id"))
    for how in ("inner", "left"):
        plain = left.join(right, "k", how)
        split = skew_join(left, right, ["k"], how, hot_rows=10, hot_share=0.01)
        assert sorted(map(repr, split.collect())) == sorted(map(repr, plain.collect()))


def test_verdicts_belong_to_texts(spark):
    """Both paths judge rows by their text: repeated and null ids, repeated and null texts."""
    rows = [(1, "all of the hidden test text here"), (1, "clean"), (None, "x of the hidden test text y"),
            (None, "clean"), (2, None), (3, "clean"), (3, "clean"), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    strings = spark.createDataFrame([("of the hidden test text",), ("HIDDEN",)], "string string")
    want = sorted([(1, "clean"), (None, "clean"), (2, None), (3, "clean"), (3, "clean"), (4, "")], key=str)
    for bound in (1, decontam.LIST_BYTES):
        left = decontam.decontaminate(docs, strings, "text", "doc_id", max_bytes=bound)
        assert sorted(map(tuple, left.collect()), key=str) == want
    left = decontam.decontaminate_anchored(docs, strings, "text", "doc_id")
    assert sorted(map(tuple, left.select("doc_id", "text").collect()), key=str) == want


def test_common_words_around_a_run(spark):
    docs = spark.createDataFrame([(1, "so a the b it is"), (2, "a the c"), (3, "the the the")], "doc_id int, text string")
    strings = spark.createDataFrame([("a the b",)], "string string")
    for bound in (1, decontam.LIST_BYTES):
        left = decontam.decontaminate(docs, strings, "text", "doc_id", max_bytes=bound)
        assert sorted(r["doc_id"] for r in left.collect()) == [2, 3]


@pytest.mark.parametrize("max_bytes", [1 << 20, 1])
def test_strings_without_blanks_and_of_any_length(spark, max_bytes):
    """One byte, two, three, eight, nine; strings that begin alike; ends of texts; letters of several bytes; a long text."""
    rng = random.Random(9)
    strings = ["q", "é", "zz", "xyz", "12345678", "123456789", "1234567890abc", "漢字かな交じり", "a the b", "no_such_text_anywhere"]
    strings += ["common prefix " + str(i) for i in range(200)]
    docs = [(i, "".join(rng.choices("abcdefg 1234567890\n", k=rng.randrange(60)))) for i in range(200)]
    docs += [(300 + i, "x" * i + s.upper()) for i, s in enumerate(strings)] + [(700 + i, s[:-1]) for i, s in enumerate(strings)]
    docs += [(600, "ab" * 400_000 + "12345678"), (601, "漢字かな交じ"), (602, "z"), (603, None), (604, "common prefix 19 and 20")]
    df = spark.createDataFrame(docs, "id bigint, text string").repartition(3)
    listed = spark.createDataFrame([(i, s) for i, s in enumerate(strings)], "ord bigint, string string")
    bad = contaminated(docs, strings)
    kept = {r["id"] for r in decontam.decontaminate(df, listed, "text", "id", max_bytes=max_bytes).collect()}
    assert kept == {i for i, _ in docs} - bad and 600 in bad and 601 not in bad
    want = {}
    for i, text in docs:
        hits = [n for n, s in enumerate(strings) if text is not None and s.lower() in text.lower()]
        if hits:
            want[i] = hits[0]
    got = decontam.contamination_hits(df, listed, "text", "ord", max_bytes=max_bytes).collect()
    assert {r["id"]: r["hit_ord"] for r in got} == want


def test_grams_that_leave_texts_are_those_of_the_list(spark):
    strings = spark.createDataFrame([("some benchmark text",)], "string string")
    runs = strings.select(F.explode(substrings.own_grams()(F.col("string"))).alias("r")).select("r.*")
    assert runs.count() == 12
    known = substrings.held_grams(spark, substrings.grams_bitmap(runs), [8])
    docs = spark.createDataFrame([("words " * 1000 + "some benchmark text",), ("nothing of it",), (None,)], "t string")
    assert [r[0] for r in docs.select(F.size(known(F.col("t")))).collect()] == [12, 0, 0]


def test_common_grams_stay_in_the_texts(spark, monkeypatch):
    """Grams that most texts hold are counted where they are; only the rarest of each string leave texts."""
    written = []

    def kept(df):
        out = df.localCheckpoint()
        written.append(out.count())
        return out

    monkeypatch.setattr(decontam, "checkpointed", kept)
    common = "words that are in all of the texts and in all of the strings"
    patterns = [(f"{common} zyx{i:03d}qq",) for i in range(5)]
    texts = [(i, f"{common} abc{i}") for i in range(300)] + [(300 + i, f"so {common.upper()} zyx{i:03d}qq.") for i in range(3)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    strings = spark.createDataFrame(patterns, "string string")
    got = decontam.decontaminate_anchored(docs, strings, "text", "doc_id")
    assert sorted(r["doc_id"] for r in got.collect()) == list(range(300))
    assert sum(written) < 1000


def test_hits_of_a_short_list_are_written_down(spark, monkeypatch):
    """All texts are read while the hits are written, where batches are short; what follows reads the hits."""
    written = []
    monkeypatch.setattr(decontam, "checkpointed", lambda df: written.append(df.count()) or df.localCheckpoint())
    docs = spark.createDataFrame([(i, f"text {i} of some") for i in range(50)], "doc_id bigint, text string")
    strings = spark.createDataFrame([("1 of", 0), ("7 OF", 1)], "string string, ord int")
    got = decontam.contamination_hits(docs, strings, "text", "ord").select("doc_id", "hit_ord")
    assert {tuple(r) for r in got.collect()} == {(i, i % 10 // 7) for i in range(50) if i % 10 in (1, 7)}
    assert 10 in written
