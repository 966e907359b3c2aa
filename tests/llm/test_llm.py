"""The ten operators and the pipeline against brute force, on small tables with every kind of odd row."""

import itertools
import re
import textwrap
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import bpe, chat, common, language, licenses, lines, minhash, repeats, sharding, tiling, vectors
from corpusflow.llm.queries import vocabulary

WORDS = re.compile(r"[^\x20\x09-\x0d]+")
RNG = np.random.default_rng(3)
VOCABULARY = [f"w{i}" for i in range(400)]


def words(text):
    return WORDS.findall((text or "").lower())


def prose(n):
    return " ".join(RNG.choice(VOCABULARY, n))


BASE, OTHER, LONG = prose(80), prose(70), prose(30_000)
EDITED = " ".join("changed" if i in (10, 50) else w for i, w in enumerate(BASE.split()))
#: Nulls, empty texts, one word, copies, a near copy, a very long text, equal ids, repeated rows.
ROWS = [
    (1, BASE), (2, EDITED), (3, OTHER), (4, None), (5, ""), (6, "one"), (7, BASE.upper()), (8, LONG),
    (9, OTHER + "\n" + prose(60)), (9, prose(40)), (10, prose(20)), (10, prose(25)), (3, OTHER), (None, prose(33)), (11, "one"),
]
SCHEMA = "doc_id long, text string, node string, kept string, key int, removed string, _ref string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x", "y", 1, "z", None, 5) for i, t in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_word_hashes_equal_for_equal_words():
    texts = ["The the\tTHE é É", "", None, "a" * 300_000 + " b", "x\ny"]
    hashes, first, edges, cuts = common.hash_words(pa.array(texts), breaks=10)
    seen = {}
    for i, text in enumerate(texts):
        found = re.findall(WORDS, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        assert len(found) == edges[i + 1] - edges[i]
        for word, value in zip(found, hashes[edges[i]: edges[i + 1]].tolist()):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen) and len(cuts) == 1


def shingle_set(text, n):
    found = words(text)
    return frozenset(tuple(found[i: i + n]) for i in range(max(1, len(found) - n + 1))) if found else frozenset()


def test_minhash(docs, empty):
    sets = [shingle_set(t, 2) for _, t in ROWS]
    group = list(range(len(ROWS)))
    for i, j in itertools.combinations(range(len(ROWS)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            a, b = group[i], group[j]
            group = [a if g == b else g for g in group]
    want = []
    for i, (doc, _) in enumerate(ROWS):
        ids = [d for (d, _), g in zip(ROWS, group) if g == group[i] and d is not None]
        low = min(ids) if ids else None
        want.append((doc, len(sets[i]), low, doc == low))
    got = minhash.components(docs, n=2).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert minhash.components(empty, n=2).count() == 0


def test_keep_one_of_each_group(docs):
    got = minhash.keep_one(docs, n=2)
    assert got.columns == docs.columns
    texts = [(r["doc_id"], r["text"]) for r in got.collect()]
    assert len(texts) == len(set(texts)) == len(ROWS) - 4  # 2 and 7 to 1, 11 to 6, the repeat of 3


def test_repeats(docs, empty, spark):
    seen = {}
    for row, (_, text) in enumerate(ROWS):
        w = words(text)
        for i in range(len(w) - 49):
            seen.setdefault(tuple(w[i: i + 50]), []).append((row, i))
    places = {p for found in seen.values() if len(found) > 1 for p in found}
    want = []
    for row, (doc, _) in enumerate(ROWS):
        span = None
        for at in sorted(i for r, i in places if r == row):
            if span and at <= span[1]:
                span[1] = at + 50
            else:
                want += [(doc, *span)] if span else []
                span = [at, at + 50]
        want += [(doc, *span)] if span else []
    got = [(r["doc_id"], r["start"], r["end"]) for r in repeats.repeated_spans(docs).collect()]
    assert sorted(got) == sorted(want) and want
    assert repeats.repeated_spans(empty).count() == 0


def test_vectors(spark):
    base = RNG.standard_normal((40, 16))
    near = base[:10] + 0.1 * RNG.standard_normal((10, 16))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate([*base, *near, base[0]])]
    rows += [(60, None), (61, [0.0] * 16), (62, [float("nan")] * 16), (63, [None] * 16), (64, []), (65, [1.0, 2.0]), (None, [3.0] * 16)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, cid int, node string")
    good = {i: np.array(v, "f4").astype("f8") for i, v in rows if v and len(v) == 16 and i is not None and i < 60}
    links = {i: {j for j in good if j != i and good[i] @ good[j] >= 0.9 * np.linalg.norm(good[i]) * np.linalg.norm(good[j])} for i in good}
    got = {r["vec_id"]: r for r in vectors.components(df, recall=0.9999).collect()}
    assert len(got) == len(rows)
    for i, r in got.items():
        reach, more = {i}, links.get(i, set())
        while more - reach:
            reach |= more
            more = set().union(*(links[j] for j in reach))
        assert r["n_links"] == len(links.get(i, ()))
        assert r["component_id"] == (None if i is None else min(reach)) and r["kept"] == (r["component_id"] == i)
    assert vectors.components(df.limit(0)).count() == 0


def test_lines(docs, empty, spark):
    more = [(20, "a b c d e\n\na b c d e f\nz"), (21, "z\nsomething else here\na b c d e"), (21, "q r s")]
    rows = ROWS + more
    df = docs.unionByName(spark.createDataFrame([(i, t, "x", "y", 1, "z", None, 5) for i, t in more], SCHEMA))
    order = sorted(dict.fromkeys(rows), key=lambda r: (r[0] is not None, r[0] or 0, rows.index(r)))
    earlier, want = [], {}
    for doc, text in order:
        gone = []
        for i, line in enumerate((text or "").split("\n")):
            s = frozenset(words(line))
            if s and any(100 * len(s & e) >= 80 * len(s | e) for e in earlier):
                gone.append(i)
            earlier.append(s)
        kept = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
        want[doc, text] = kept
    got = lines.dedup_lines(df, out="removed")
    assert sorted(got.columns) == sorted(df.columns)
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in got.collect()))) == sorted(str((d, want[d, t])) for d, t in rows)
    assert lines.dedup_lines(empty).count() == 0


@pytest.mark.parametrize("sizes", [{"frequent": 2, "hubs": 1}, {"crowded": 2, "hubs": 1}])
def test_lines_in_rounds(spark, sizes):
    """Sizes so small that the words are worked off in rounds, where classes go under one word and stay open under others."""
    rng = np.random.default_rng(5)
    pool = [f"v{i}" for i in range(30)]
    # Under "w" the first class and the second go through other words; the third is open alone and matches the second.
    c, d = ([f"{x}{i}" for i in range(7)] for x in "cd")
    start = [["l", "z", *d], ["l", "w", *d], ["b", "y", *c], ["b", "w", *c], ["u", "w", *c], *[[x] * 9 for x in c + d]]
    rows = []
    for i in range(120):
        if i < 30 or rng.random() < 0.3:
            own = set(rng.choice(pool, int(rng.integers(5, 10)), replace=False).tolist())
        else:
            own = set(rows[int(rng.integers(len(rows)))])
            own.discard(rng.choice(sorted(own)))
            own.add(str(rng.choice(pool)))
        rows.append(sorted(own))
    rows, want = start + rows, []
    for i, own in enumerate(rows):
        if any(100 * len(set(own) & set(e)) >= 80 * len(set(own) | set(e)) for e in rows[:i]):
            want.append(i)
    df = spark.createDataFrame([(i, " ".join(own)) for i, own in enumerate(rows)], "doc_id long, text string")
    got = lines.removed_lines(df, **sizes)
    assert sorted(r["_id"] for r in got.collect()) == want and want[:3] == [1, 3, 4]


def test_lines_by_string_ids(spark):
    """The order is that of the ids, not that of reading, whatever their type."""
    rows = [("c", "p q r s t u"), ("b", "p q r s t"), ("a", "p q r s t v"), (None, "k l m n o"), ("d", "k l m n o j"), ("e", "x")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    assert sorted(r["_id"] for r in lines.removed_lines(df).collect()) == ["b", "c", "d"]
    assert sorted(r["_id"] for r in lines.removed_lines(df, frequent=2).collect()) == ["b", "c", "d"]


def test_language(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    apart = language.held_out(F.col("doc_id"))
    model = language.fit(docs.where(~apart))
    found = docs.where(apart).select("lang", language.predict(docs, model)["lang"].alias("p")).collect()
    assert sum(r["lang"] == r["p"] for r in found) >= 0.97 * len(found)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !"), (4, "é")], "doc_id int, text string")
    got = [r["p"] for r in odd.orderBy("doc_id").select(language.predict(odd, model).alias("p")).collect()]
    assert [p["lang"] for p in got[:3]] == ["und"] * 3 and got[3]["lang"] in model["languages"]
    assert all(0 <= p["score"] <= 1 for p in got)
    none = language.fit(docs.limit(0))
    assert odd.select(language.predict(odd, none)["lang"].alias("p")).distinct().collect()[0]["p"] == "und"


@pytest.mark.parametrize("k", [1, 2, 4, 7, 30])
def test_codewords_differ(k):
    code = language.codewords(k)
    assert len({tuple(row) for row in code.tolist()}) == k


def test_bpe(spark):
    from tokenizers import Tokenizer

    path = vocabulary()
    known = Tokenizer.from_file(path)
    pool = "abcdefgh  '’sStTdD\n\tΣσςİßéÉ 1²½<|>漢字かな_-!?…😀"
    texts = ["", "<|endoftext|>", "a<|startoftext|>b", "I'll DON'T", "x" * 5000, prose(2000)]
    texts += ["".join(RNG.choice(list(pool), RNG.integers(1, 60))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([None, *texts])], "id int, text string")
    coded = df.select("id", bpe.encoder(spark, path)(F.col("text")).alias("ids"))
    got = coded.select("id", "ids", bpe.decoder(spark, path)(F.col("ids")).alias("back")).orderBy("id").collect()
    assert got[0]["ids"] == [] and got[0]["back"] == ""
    for row, text in zip(got[1:], texts):
        want = known.encode(text, add_special_tokens=False).ids
        assert row["ids"] == want, text
        assert row["back"] == known.decode(want, skip_special_tokens=False)
    assert df.limit(0).select(bpe.encoder(spark, path)(F.col("text"))).count() == 0


def test_tiling(spark, docs, empty):
    item = [f"b{i}" for i in range(30)]
    halves = " ".join(item[15:]) + " " + prose(40) + " " + " ".join(item[:15])
    partial = " ".join(item[:20])
    items = spark.createDataFrame([(1, " ".join(item)), (1, " ".join(item)), (2, "tiny pair"), (3, None), (4, "")], "item_id int, text string")
    rows = [(1, " ".join(item).upper()), (2, halves), (3, partial), (4, "a tiny, pair!"), (5, None), (2, halves), (6, prose(50))]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, item int")
    got = sorted((r["doc_id"], r["item"], r["covered"], len(r["tiles"])) for r in tiling.contamination(df, items).collect())
    assert got == [(1, 1, 30, 1), (2, 1, 30, 2), (2, 1, 30, 2), (4, 2, 2, 1)]
    assert sorted(r["doc_id"] for r in tiling.decontaminate(df, items).collect()) == [3, 5, 6]
    assert tiling.decontaminate(docs, items.limit(0)).count() == len(ROWS)
    assert tiling.contamination(empty, items).count() == 0


def test_tiles_mark_the_longest_first():
    # The text holds words 0-8 and then 5-14 of the item: the longer match wins the overlap.
    seeds = [(i, i) for i in range(5)] + [(5 + i, 20 + i) for i in range(6)]
    assert tiling.tiles([s[0] for s in seeds], [s[1] for s in seeds], 15) == [(5, 20, 10), (0, 0, 5)]


def test_licenses(spark):
    mit = dict(licenses.KNOWN[:1])["MIT"]
    rows = [
        (1, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace("LICENSE", "LICENCE")), (2, "prose\nLicenced under CC BY-NC 4.0"),
        (3, None), (4, ""), (5, mit + " and more"), (6, "Copyright 2020 A"), (2, "x"),
    ]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, license string, digest string")
    got = sorted((r["doc_id"], r["license"], r["whole"], r["lines"]) for r in licenses.licenses_of(df).collect())
    assert got == [(1, "MIT", True, 0), (2, "CC-BY-NC-4.0", False, 1)]
    assert licenses.licenses_of(df.limit(0)).count() == 0


ISC_FILE = """ISC License

Copyright (c) 2004-2010 by Internet Systems Consortium, Inc. ("ISC")
Copyright 1995-2003 by Internet Software Consortium

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND ISC DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL ISC BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE
OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
"""


def test_published_licenses(spark):
    """Files as they are published: with titles and notices, at any width of lines."""
    def wrapped(text, width):
        return "\n\n".join(textwrap.fill(p, width) for p in text.split("\n\n"))

    texts = {}
    for name, text in licenses.KNOWN:
        texts.setdefault(name, text)
    heads = {
        "MIT": "MIT License\n\nCopyright (c) 2020 Jane Doe", "BSD-2-Clause": "BSD 2-Clause License\n\nCopyright 2020, Jane Doe\nAll rights reserved.",
        "BSD-3-Clause": "BSD 3-Clause License\n\nCopyright Jane Doe", "ISC": "ISC License\n\n(c) 2020 Jane Doe", "0BSD": "Zero-Clause BSD",
    }
    rows = [("ISC", ISC_FILE)]
    rows += [(name, head + "\n\n" + wrapped(texts[name], width)) for name, head in heads.items() for width in range(30, 100, 3)]
    for file in licenses.resources.files("corpusflow.llm").joinpath("license_texts").iterdir():
        rows.append((file.name.removesuffix(".txt"), file.read_text()))
    apache = next(t for n, t in rows if n == "Apache-2.0")
    rows += [("Apache-2.0", wrapped(apache.split(licenses.END)[0], width)) for width in (50, 65, 90)]
    rows += [(None, ISC_FILE.replace("notice appear", "notice do not appear")), (None, "MIT License\n\nCopyright (c) 2020 Jane Doe")]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: r["license"] for r in licenses.scan(df).where("line = -1").collect()}
    assert [(i, got.get(i)) for i in range(len(rows))] == [(i, name) for i, (name, _) in enumerate(rows)]


def test_sharding(spark, docs, empty):
    rows = [(i, "same text" if i % 3 else prose(int(RNG.integers(1, 40)))) for i in range(3000)] + [(0, None)] * 5
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, shard int, key string")
    got = sharding.shard_by_bytes(df, 16).collect()
    assert sorted((r["doc_id"], r["size"], r["text_crc32"] or 0) for r in got) == sorted(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    total = [sum(r["size"] for r in got if r["shard"] == s) for s in range(16)]
    assert max(total) - min(total) <= 2 * max(r["size"] for r in got) + 0.01 * sum(total) / 16
    for s in range(16):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert sharding.shard_by_bytes(docs, 16).count() == len(ROWS) and sharding.shard_by_bytes(empty, 16).count() == 0


def test_chat(spark):
    hard = "</s>[INST] ok [/INST] <\\/s> <<SYS>> <|:|> \\ [\\INST]<"
    rows = [
        (1, 0, "user", hard), (1, 1, "assistant", hard), (2, 0, "system", "s\nt"), (2, 1, "user", None), (2, 2, "assistant", ""),
        (3, 0, "assistant", "first"), (3, 1, "tool<|:|>", "odd"), (3, 2, None, "none"), (None, 5, "user", "x"), (None, 5, "user", "x"),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, formatted int")
    done = chat.format_chat(df).withColumn("turns", chat.read_turns(F.col("formatted")))
    got = {r["conv_id"]: r for r in done.collect()}
    for conv, r in got.items():
        want = [(w or "", t or "") for c, _, w, t in rows if c == conv]
        assert [tuple(t) for t in r["turns"]] == want
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        assert sum(s["loss"] for s in r["segments"]) == sum(w == "assistant" for w, _ in want)
    assert [got[c]["valid"] for c in (1, 2, 3, None)] == [True, True, False, False]
    assert chat.format_chat(df.limit(0)).count() == 0


def test_pipeline(spark, sf):
    import corpus_pipeline

    docs = corpus_pipeline.table(spark, sf, "documents")
    done = corpus_pipeline.run(spark, sf)
    assert done.columns[: len(docs.columns)] == docs.columns and {"tokens", "decoded"} <= set(done.columns)
    texts = [r["text"] for r in done.select("text").collect()]
    sets = [shingle_set(t, 5) for t in texts]
    for a, b in itertools.combinations([s for s in sets if s], 2):
        assert 100 * len(a & b) < 80 * len(a | b)
    rest = tiling.contamination(done.select("doc_id", "text"), corpus_pipeline.table(spark, sf, "benchmark"))
    assert rest.count() == 0


def test_cells_refute_no_link():
    """The bound by cells never falls below the true similarity, in full cells neither."""
    rng = np.random.default_rng(3)
    for size in (1, 5, 200, 100_000):
        pool = rng.integers(0, 1 << 62, 2 * size, dtype=np.int64).astype(np.uint64)
        sets = [set(pool[rng.random(len(pool)) < share].tolist()) or {1} for share in (0.5, 0.9, 0.95, 0.97, 1.0)]
        cells = []
        for s in sets:
            at = (np.array(sorted(s), dtype=np.uint64) % np.uint64(minhash.CELLS)).astype(np.int64)
            cells.append(np.minimum(np.bincount(at, minlength=minhash.CELLS), minhash.FULL).astype(np.uint8).tobytes())
        places = [(i, j) for i in range(len(sets)) for j in range(len(sets))]
        x, y = (pa.array([cells[p[k]] for p in places], pa.binary()) for k in (0, 1))
        n, m = (pa.array([len(sets[p[k]]) for p in places], pa.int32()) for k in (0, 1))
        may = minhash._may_link(80).func(x, y, n, m).to_pylist()
        for (i, j), passed in zip(places, may):
            shared = len(sets[i] & sets[j])
            assert passed or 100 * shared < 80 * (len(sets[i]) + len(sets[j]) - shared)


def test_minhash_tests_few_pairs_of_a_large_group(spark, monkeypatch):
    """A group of texts that share buckets but no links, in blocks too, must not become its pairs; no link is lost."""
    rng = np.random.default_rng(11)
    pool = [f"v{i}" for i in range(4000)]
    base = rng.choice(pool, 150).tolist()

    def edited(text, n):
        out = list(text)
        for i in rng.choice(len(out), n, replace=False):
            out[i] = str(rng.choice(pool))
        return out

    texts = [edited(base, 10) for _ in range(150)]
    texts += [edited(t, 3) for t in texts[::3]]
    sets = [shingle_set(" ".join(t), 2) for t in texts]
    group = list(range(len(sets)))
    for i, j in itertools.combinations(range(len(sets)), 2):
        if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and group[i] != group[j]:
            a, b = group[i], group[j]
            group = [a if g == b else g for g in group]
    low = {g: group.index(g) for g in set(group)}
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    tested, confirm, inside = [], minhash.confirm, minhash.clusters_in_buckets

    def counted(pairs, sets, least):
        tested.append(pairs.count())
        return confirm(pairs, sets, least)

    monkeypatch.setattr(minhash, "confirm", counted)
    for size in (None, 16):
        if size:
            monkeypatch.setattr(minhash, "clusters_in_buckets", lambda m, s, least: inside(m, s, least, block=size))
        tested.clear()
        got = {r["doc_id"]: r["component_id"] for r in minhash.components(docs, n=2).collect()}
        assert got == {i: low[g] for i, g in enumerate(group)}
        assert sum(tested) < 25 * len(texts), tested


def test_bpe_stage_needs_one_python_worker_a_task(docs):
    """Encoding and decoding in two nodes keeps two workers a task, and both stay for the stages after it."""
    import corpus_pipeline

    done = corpus_pipeline.encode(docs.sparkSession, docs, "")
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bArrowEvalPython\b", plan)) == 1, plan
    path = vocabulary()
    two = docs.withColumn("want", bpe.encoder(docs.sparkSession, path)(F.col("text")))
    two = two.withColumn("back", bpe.decoder(docs.sparkSession, path)(F.col("want"))).select("want", F.size("want"), "back")
    got = done.select("tokens", "n_tokens", "decoded")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, two.collect())))
    assert done.columns == [*docs.columns, "tokens", "n_tokens", "decoded"]


def test_lines_pair_under_several_frequent_words_is_made_once(spark):
    """Classes that share three words meet in one row of the join, not in three."""
    schema = "word long, _id long, cid long, pos int, n int, x long, y long, words array<long>"
    rows = [(w, i, i, pos, 20, 0, 0, [5, 6, 7]) for i in range(4) for pos, w in enumerate((5, 6, 7))]
    entries = spark.createDataFrame(rows, schema)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        met = lines.candidates(entries, entries.where("cid = 0"), 80, once=True)
        assert sorted(map(tuple, met.collect())) == [(1, 0), (2, 0), (3, 0)]
        nodes, made = [met._jdf.queryExecution().executedPlan()], []
        while nodes:
            node = nodes.pop()
            children = node.children()
            nodes += [children.apply(i) for i in range(children.size())]
            if "Join" in node.nodeName() and "word" in node.simpleString(200):
                made.append(node.metrics().apply("numOutputRows").value())
        assert 3 in made and max(made) <= 3, made
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_lines_pair_that_knows_its_prefixes_is_made_once(spark):
    """The same where the earlier side brings its entries along; a pair whose first word is not asked under is left to that word."""
    schema = "word long, _id long, cid long, pos int, n int, x long, y long, words array<long>, prefix array<long>"
    rows = [(w, i, i, pos, 20, 0, 0, [5, 6, 7], [5, 1 << 32 | 6, 2 << 32 | 7]) for i in range(4) for pos, w in enumerate((5, 6, 7))]
    entries = spark.createDataFrame(rows, schema)
    earlier = entries.where("cid = 0").drop("words")
    met = lines.candidates(entries.drop("prefix"), earlier, 80, once=True)
    assert sorted(map(tuple, met.collect())) == [(1, 0), (2, 0), (3, 0)]
    assert "line-hubs" not in met._jdf.queryExecution().toString()
    assert lines.candidates(entries.drop("prefix").where("word > 5"), earlier, 80, once=True).count() == 0


def test_lines_name_the_class_right_before(spark):
    """Named pairs against brute force: sizes far apart, repeated places, ids in another order than classes, one crowded word."""
    rng = np.random.default_rng(3)
    rows = []
    for cid in range(300):
        n, x, y = int(rng.integers(4, 40)), int(rng.integers(0, 8)), int(rng.integers(0, 8))
        found = sorted(set(rng.integers(1, 40, 3).tolist())) + ([99] if cid % 2 else [])
        rows.append((int(rng.integers(0, 200)), cid, n, x, y, [place << 32 | w for place, w in enumerate(found)]))
    df = spark.createDataFrame(rows, "rank long, cid long, n int, x long, y long, prefix array<long>")
    want = {}
    for rank, cid, n, x, y, prefix in rows:
        for e in prefix:
            met = []
            for rank2, other, m, u, v, there in rows:
                for e2 in there:
                    if e2 & 0xFFFFFFFF == e & 0xFFFFFFFF != 99 and (rank2, other) < (rank, cid):
                        shared = -(-80 * (n + m) // 180)
                        fits = 100 * min(n, m) >= 80 * max(n, m) and min(n - (e >> 32), m - (e2 >> 32)) >= shared
                        if fits and (x ^ u).bit_count() + (y ^ v).bit_count() <= n + m - 2 * shared:
                            met.append((rank2, other))
            if met:
                pair = cid, max(met)[1]
                want[pair] = want.get(pair, False) or len(met) > 1
    got = lines.named_pairs(df, 80, 3, most=100).collect()
    assert [r["word"] for r in got if r["cid"] is None] == [99]
    assert {(r["cid"], r["other"]): bool(r["more"]) for r in got if r["cid"] is not None} == want
    assert len(got) == len(want) + 1 > 200


def test_counting_words_is_quicker_than_sorting_them():
    """A one of another type than the counters made this several times slower than a sort."""
    found = np.random.default_rng(1).integers(0, 1 << 62, 1 << 19).astype(np.uint64)

    def least_time(run):
        took = []
        for _ in range(5):
            began = time.process_time()
            run()
            took.append(time.process_time() - began)
        return min(took)

    total = np.zeros(1 << 16, dtype=np.int32)
    assert least_time(lambda: lines.add_words(total, found)) < least_time(lambda: np.sort(found, kind="heapsort"))
    assert (total == 5 * np.bincount((found & np.uint64(0xFFFF)).astype(np.int64), minlength=1 << 16)).all()


def test_tokens_leave_block_by_block(spark, monkeypatch):
    """A batch of many texts gives its tokens in pieces, not as one array that holds them all."""
    monkeypatch.setattr(bpe, "BLOCK", 1000)
    texts = [f"some words of text {i} " * 10 for i in range(40)] + [None, "", "x" * 5000]
    for udf in (bpe.coder(spark, vocabulary()), bpe.encoder(spark, vocabulary())):
        out = list(udf.func(iter([pa.array(texts), pa.array([], pa.string())])))
        assert len(out) > 5 and max(map(len, out)) <= 10 and sum(map(len, out)) == len(texts)


def test_tiling_runs_one_worker_a_task(spark, monkeypatch):
    """Filters on seeds and tiles ran their functions twice, by two workers a task that stayed for the stages after it."""
    docs = spark.createDataFrame([(1, BASE), (2, OTHER), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, BASE)], "item_id long, text string")
    plans, write = {}, tiling.written

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(tiling, "written", seen)
    assert [r["doc_id"] for r in tiling.contamination(docs, items).collect()] == [1]
    made = {name: len(re.findall(r"ArrowEvalPython \[", plan.split("+- == Initial Plan ==")[0])) for name, plan in plans.items()}
    assert made["hits"] == 1 and made["contaminated"] == 1, (made, plans["hits"])


def test_full_sets_run_one_worker_a_task(spark, monkeypatch):
    """A filter on the sets ran their function twice, by two workers a task that stayed for the stages after it."""
    docs = spark.createDataFrame([(1, BASE), (2, BASE + " end"), (3, OTHER), (4, None), (5, BASE)], "doc_id long, text string")
    plans, write = {}, minhash.written

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(minhash, "written", seen)
    got = {r["doc_id"]: r["component_id"] for r in minhash.components(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 1}
    made = {name: len(re.findall(r"ArrowEvalPython \[", plan.split("+- == Initial Plan ==")[0])) for name, plan in plans.items()}
    assert made["sets"] == 1 and max(made.values()) == 1, (made, plans["sets"])


def test_pipeline_bounds_the_batches_its_caller_reads(docs):
    """The first and the last stage ran in the session's own batches, which workers and executors kept."""
    import corpus_pipeline

    spark, key = docs.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    texts = spark.range(0, 6000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 200).alias("text"))
    texts = texts.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("de"))
    try:
        for stage, n in ((corpus_pipeline.identify_language, None), (corpus_pipeline.encode, 6000)):
            spark.conf.set(key, str(1 << 30))
            done = stage(spark, texts, "")
            assert int(spark.conf.get(key)) <= corpus_pipeline.BATCH_BYTES
            assert n is None or done.count() == n
            spark.conf.set(key, "1000")
            stage(spark, texts, "")
            assert spark.conf.get(key) == "1000"
    finally:
        spark.conf.set(key, before)
