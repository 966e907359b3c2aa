"""Phrases, prefix tries and context trees against brute force, on small tables with every kind of odd row."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from compare import connect
from pyspark.sql import functions as F

from corpusflow.llm import blocks, collocations, contexts, quotients, scoring, tries
from corpusflow.llm import queries as registered

RNG = np.random.default_rng(11)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_words_and_pieces():
    texts = ["Ab, c d. E\tf", None, "", "x", ".", "é É;z  Z\x0b\x0by", "last", " lead trail "]
    kinds = blocks.classes(b" \t", b".,;:!?\n\x0b\x0c\r")
    words, edges, joined = blocks.split_words(pa.array(texts), kinds)
    for i, text in enumerate(texts):
        want, first = [], []
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lower(text)):
            own = re.findall(r"[^ \t]+", piece)
            want += own
            first += [True] + [False] * (len(own) - 1) if own else []
        part = slice(edges[i], edges[i + 1])
        assert words[part].to_pylist() == want
        assert (~joined[part]).tolist() == first


@pytest.mark.parametrize("word", [1, 2, 7, 19, 21, 22, 30, 32])
@pytest.mark.parametrize("size", [2, 3])
def test_filters_lose_nothing(word, size):
    for shard in (0, 3, 8):
        shape = quotients.shape(word, size, shard, 1 << 10)
        ids = [RNG.integers(0, 1 << word, 3000) for _ in range(size)]
        for i in ids:
            i[:100] = i[0]
        packed = quotients.pack(ids, shape)
        assert all((a == b).all() for a, b in zip(quotients.unpack(*packed, shape), ids))
        moved = quotients.permute(*packed, shape)
        assert all((a == b).all() for a, b in zip(quotients.restore(*moved, shape), packed))
        counts = RNG.integers(1, 600, 3000)
        halves = [
            dict(quotients.encode(*quotients.counted(*(m[part] for m in moved), counts[part], shape), shape))
            for part in (slice(0, 1700), slice(1700, None))
        ]
        got = collections.Counter()
        for number in set(halves[0]) | set(halves[1]):
            upper, lower_, n = quotients.merged(number, [h[number] for h in halves if number in h], shape)
            keys = list(zip(upper.tolist(), lower_.tolist()))
            assert keys == sorted(set(keys)) and (quotients._shift(upper, shape.inner) == number).all()
            back = quotients.unpack(*quotients.restore(upper, lower_, shape), shape)
            got.update(dict(zip(zip(*(b.tolist() for b in back)), n.tolist())))
        want = collections.Counter()
        for key, n in zip(zip(*(i.tolist() for i in ids)), counts.tolist()):
            want[key] += n
        assert got == want


def phrases(rows, least=10, inside=50, top=2000):
    """Collocations by counting everything."""
    grams = collections.defaultdict(collections.Counter)
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lower(text)):
            w = re.findall(r"[^ \t]+", piece)
            for n in (1, 2, 3):
                grams[lang or "und"].update(tuple(w[i: i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in grams.items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        found = []
        for gram, a in f.items():
            if len(gram) == 1 or a < least:
                continue
            if len(gram) == 2 and any(len(g) == 3 and gram in (g[:2], g[1:]) and c >= least and 100 * c >= inside * a for g, c in f.items()):
                continue
            cuts = [(1_000_000 * a * a // (f[gram[:k]] * f[gram[k:]]), k) for k in range(1, len(gram))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(gram).encode(), f[gram[:k]], f[gram[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def phrase_rows():
    pool = ["the", "of", "New", "york", "CITY", "é", "É", "a\x01", "b", "x-y"]
    rows = [(i, " ".join(RNG.choice(pool, int(RNG.integers(0, 40)))) + str(RNG.choice(["", ". ", ", end", "\nnew york"])), str(RNG.choice(["en", "de"]))) for i in range(150)]
    rows += [(200 + i, "Hot Spot here! again", "en") for i in range(60)]
    rows += [(300, None, "en"), (301, "", None), (302, "lone words in no language " * 12, None), (303, " ".join(["go"] * 5000), "de"), (303, " ".join(["go"] * 5000), "de")]
    return rows


@pytest.mark.parametrize("setting", [{}, {"block_bytes": 500}, {"top": 7}])
def test_collocations(spark, setting):
    rows = phrase_rows()
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, lang string, id int, word string, a int")
    got = collocations.collocations(df.repartition(5), **setting)
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert got.columns == names
    assert sorted(tuple(r) for r in got.collect()) == phrases(rows, top=setting.get("top", 2000))
    if not setting:
        assert collocations.collocations(df.limit(0)).count() == 0


def test_collocations_in_small_shards(spark, monkeypatch):
    """Many filters of many shards, merged in steps."""
    for name, value in (("HELD", 64), ("SHARD_GRAMS", 200), ("FAN_IN", 3)):
        monkeypatch.setattr(collocations, name, value)
    rows = phrase_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(tuple(r) for r in collocations.collocations(df).collect()) == phrases(rows)


def trie(seqs):
    """Nodes of {conversation: [(role, text)]} by enumeration of all prefixes."""
    members = collections.defaultdict(list)
    for conv, seq in seqs.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(conv)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, own in members.items():
        words = len(re.findall(tries.WORD, p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(own) - 1) * words
            leaves[p[:d]] += p not in children
    out = []
    for p, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(seqs[c]) == len(p))
        up = min(members[p[:-1]]) if p else None
        out.append((min(own), len(p), up, len(own), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations():
    rows = []
    for c in range(-3, 90):
        if c % 11 == 3:
            continue
        turns = int(RNG.integers(1, 7)) if c % 20 else 5
        rows += [(c, t, ("user", "assistant")[t % 2], "same words here" if c % 7 < 4 else f"text {int(RNG.integers(3))}") for t in range(turns)]
    rows += [(200 + i, t, "user", f"deep {t if t < 30 + i else (t, i)}") for i in range(6) for t in range(40)]  # forks deep down
    rows += [(300 + i, t, "user", f"copied {t}") for i in range(20) for t in range(9)]
    rows += [(400, None, None, None), (400, None, "", ""), (400, 0, "user", ""), (401, 0, "user\x00", "a  b\tc"), (None, 1, "user", "x")]
    rows += [(500, 1, "user", "twice"), (500, 1, "user", "twice")]
    return rows


def gathered(rows):
    out = collections.defaultdict(list)
    for c, t, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        out[c].append((role or "", text or ""))
    return dict(out)


CONVERSATION = "conv_id long, turn long, role string, text string, seq string, head int"


@pytest.mark.parametrize("capacity", [1 << 14, 200, 4])
def test_trie(spark, capacity, monkeypatch):
    monkeypatch.setattr(tries, "PIECE", 3)
    monkeypatch.setattr(tries, "PATIENCE", 3)
    rows = conversations()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], CONVERSATION).repartition(4)
    got = tries.prefix_trie(df, capacity=capacity)
    assert sorted((tuple(r)[:8] for r in got.collect()), key=str) == trie(gathered(rows))


def test_trie_of_rebuilt_conversations(spark):
    rows = conversations()
    own = gathered(rows)
    rebuilt = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        rebuilt[c] = own.get(base, [])[:h] + seq[h:]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], CONVERSATION)
    got = tries.nodes(tries.with_shared_starts(tries.sequences(df)), capacity=50)
    assert sorted((tuple(r)[:8] for r in got.collect()), key=str) == trie(rebuilt)
    assert tries.prefix_trie(df.limit(0)).count() == 0
    texts = {bytes(r["turn"]): (r["role"], r["text"]) for r in tries.turn_texts(df).collect()}
    last = {(r["conv_id"], r["depth"]): r["turn"] for r in got.collect()}
    assert texts[bytes(last[300, 9])] == ("user", "copied 8") and last[-3, 0] is None


class Tree:
    """Context-tree weighting by its definition, a dictionary of counts and recursion."""

    def __init__(self, texts, depth):
        self.depth, self.counts = depth, collections.defaultdict(lambda: [0, 0])
        self.below = collections.defaultdict(set)
        for text in texts:
            for context, byte in self.steps(text):
                for k in range(depth + 1):
                    m = 1
                    for j in range(8):
                        bit = byte >> (7 - j) & 1
                        self.counts[context[:k], m][bit] += 1
                        if k:
                            self.below[context[: k - 1], m].add(context[:k])
                        m = 2 * m + bit
        self.cache = {}

    def steps(self, text):
        data = bytes([255] * self.depth) + lower(text).encode() + b"\xff"
        for i in range(self.depth, len(data)):
            yield data[i - self.depth: i][::-1], data[i]

    def own(self, node):
        a, b = self.counts[node] if node in self.counts else (0, 0)
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def longer(self, node):
        return sum(self.weighted((c, node[1])) for c in self.below.get(node, ()))

    def weighted(self, node):
        if node not in self.cache:
            own = self.own(node)
            if len(node[0]) < self.depth:
                other = self.longer(node)
                top = max(own, other)
                own = top + math.log(0.5 * math.exp(own - top) + 0.5 * math.exp(other - top))
            self.cache[node] = own
        return self.cache[node]

    def p(self, context, m, bit, k=0):
        node = context[:k], m
        a, b = self.counts[node] if node in self.counts else (0, 0)
        own = ((b if bit else a) + 0.5) / (a + b + 1)
        if k == self.depth:
            return own
        ratio = math.exp(min(700, max(-700, self.own(node) - self.longer(node))))
        return (ratio * own + self.p(context, m, bit, k + 1)) / (ratio + 1)

    def score(self, text):
        total = 0.0
        for context, byte in self.steps(text):
            m = 1
            for j in range(8):
                bit = byte >> (7 - j) & 1
                total += math.log10(self.p(context, m, bit))
                m = 2 * m + bit
        return total


def scored_rows():
    pool = "the cat sat on a mat with É and Zoë ".split()
    rows = [(i, " ".join(RNG.choice(pool, int(RNG.integers(1, 30))))) for i in range(60)]
    return rows + [(60, None), (61, ""), (62, "unseen words qqq"), (62, "unseen words qqq"), (None, "no id"), (63, "漢字 \t\n x"), (64, "z" * 3000)]


@pytest.mark.parametrize("setting", [{}, {"block_bytes": 300, "shard_bytes": 200}, {"depth": 4, "low": 2}])
def test_scoring(spark, setting, monkeypatch):
    monkeypatch.setattr(contexts, "WINDOW", 700)
    rows = scored_rows()
    apart = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    assert any(apart)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, learn int, codes string").repartition(3)
    learn = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) != 2, F.lit(True))
    got = scoring.score_texts(df, learn, **setting).collect()
    tree = Tree([t for (_, t), out in zip(rows, apart) if not out], setting.get("depth", scoring.DEPTH))
    counts = collections.Counter()
    for (_, text), out in zip(rows, apart):
        if not out:
            counts.update([*re.findall(r"[^\x20\x09-\x0d]+", lower(text)), None])
    n, v = sum(counts.values()), len(counts)
    want = []
    for (i, text), out in zip(rows, apart):
        tokens = [*re.findall(r"[^\x20\x09-\x0d]+", lower(text)), None]
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        want.append((i, not out, len(tokens), sum(counts[t] > 0 for t in tokens), n, base, tree.score(text)))
    order = lambda r: (r[0] is not None, r[0] or 0)
    for a, b in zip(sorted(map(tuple, got), key=order), sorted(want, key=order), strict=True):
        assert a[:5] == b[:5]
        assert a[5:7] == pytest.approx(b[5:7], rel=1e-4, abs=1e-6)
        assert a[7] == pytest.approx(-b[6] / math.log10(2) / (len(lower(rows[[r[0] for r in rows].index(b[0])][1]).encode()) + 1), rel=1e-4)


def test_scoring_without_texts(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id long, text string")
    got = {r["id"]: r for r in scoring.score_texts(df, F.lit(False)).collect()}
    assert got[1]["score"] == pytest.approx(24 * math.log10(0.5)) and got[2]["score"] == pytest.approx(8 * math.log10(0.5))
    assert got[1]["train_tokens"] == 0 and got[1]["n_known"] == 0 and got[1]["base_score"] == 0
    assert scoring.score_texts(df.limit(0), F.lit(True)).count() == 0


def test_probabilities_of_a_context_add_to_one():
    texts = pa.array(["abab abba", "baab"])
    codes, counts = (np.concatenate(p) for p in zip(*(contexts.distinct(c) for c, _, _ in contexts.windows(texts, 4))))
    codes, counts = contexts.distinct(codes, counts)
    context = codes[5] >> np.uint64(8) << np.uint64(8)
    every = context | np.arange(256, dtype=np.uint64)
    codes, counts = contexts.distinct(np.append(codes, every), np.append(counts, np.zeros(256, np.int64)))
    found = contexts.levels(codes, counts, 4, 3)
    keys, zeros, ones, logs = contexts.parts_above(found[-1])
    cost = contexts.log10_of(found, contexts.tops(keys, zeros, ones, logs / contexts.UNIT, 3))
    assert (10 ** cost[np.isin(codes, every)]).sum() == pytest.approx(1)


def test_registered_queries(spark, sf):
    """The queries as registered: against SQL, and the model against its base on texts it did not learn from."""
    con = connect(sf)
    for name in ("op11_collocations", "op12_trie"):
        got = registered.QUERIES[name](spark, sf)
        want = con.execute(registered.ORACLES[name])
        names = sorted(got.columns)
        assert sorted(d[0] for d in want.description) == names
        theirs = [tuple(row[[d[0] for d in want.description].index(n)] for n in names) for row in want.fetchall()]
        assert sorted(map(str, (tuple(r[n] for n in names) for r in got.collect()))) == sorted(map(str, theirs))
    rows = registered.QUERIES["op13_scoring"](spark, sf).collect()
    docs = {i: t for i, t in con.execute("select doc_id, text from documents").fetchall()}
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    apart = [r for r in rows if r["held_out"]]
    assert apart and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2) for r in rows)
    # Bytes cost less than the eight bits of no model, the learned texts less than those kept apart.
    bits = lambda some: sum(-r["score"] for r in some) / math.log10(2) / sum(len(docs[r["doc_id"]].encode()) + 1 for r in some)
    assert bits([r for r in rows if not r["held_out"]]) < bits(apart) < 4
