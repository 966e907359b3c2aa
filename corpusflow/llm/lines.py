"""Line dedup: an exact set-similarity self-join of lines, without the matches that come later.

A line is the set of its words. Two lines match at Jaccard similarity ``least`` or more; a line goes if
any line before it, in the order of ids and line numbers, matches it. Equal sets are one class that
stands where its first line stands, so copies never meet each other.

Words are ordered by rarity: their counts over all lines, hashed into a table of fixed size, then by
hash. Any order that is the same for all lines gives the exact result; rarity only keeps candidates
few. Classes that can match share a word in their prefixes, and pass the length filter, the positional
filter and a bitmap filter (each set bit that the other lacks stands for a word that it lacks); the
pairs left are verified on the full sets.

A class needs one earlier match to go. Under each word it first names the few candidates right before
it; only a class that none of them matches, and that has more, names all of them. Words too frequent for
that are worked off in rounds: all classes under a word meet the first of them, then growing samples of
the others, until no class is open or every class has been in a sample. So a large group of near copies
is settled by a few pairs per line instead of by all its pairs, and no match is lost.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+`` with A-Z as a-z; lines end at ``\\n``; a line without
words always stays; a null text has no lines and stays null. Rows with equal id and text are one
document and get the same lines removed; other rows with equal ids follow each other as they are
read; null ids come first. A document may lose all its lines; it
stays, with an empty text. Columns beside id and text pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import common
from corpusflow.llm.common import written
from corpusflow.operators.index import global_index
from corpusflow.operators.sizing import broadcast_if_small, fits, lookup, skew_join

#: Counters of the rarity table: one byte each in every worker, whatever the vocabulary.
COUNTERS = 1 << 22
#: Counters that travel together; places among them take two bytes.
PACKED = 1 << 16
#: Bytes of texts that are hashed together.
HASHED = 1 << 20
#: Words of texts that are sorted together.
SORTED_WORDS = 1 << 18
#: Words counted this often or more are worked off in rounds, so that a bucket of the others stays small.
FREQUENT = 1 << 16
#: So are words with more classes than this: all pairs under fewer are compared where they are.
CROWDED = 1 << 12
#: Buckets of words per shuffle partition, and entries that a task packs at a time.
BUCKETS, PACKED_ENTRIES = 2, 1 << 17
#: Classes per frequent word that the others meet in the first round, and their growth per round.
HUBS, GROWTH = 256, 16


def code_of(n):
    """The byte that stands for a count."""
    return np.minimum(255, np.floor(12 * np.log2(n)))


def add_words(total: np.ndarray, words: np.ndarray) -> None:
    """Counts words in their counters."""
    # A one of the table's own type: of another, add.at leaves its fast loop and takes ten times as long.
    np.add.at(total, (words & np.uint64(len(total) - 1)).astype(np.int64), total.dtype.type(1))


def word_rarity(docs: DataFrame, text: str, counters: int = COUNTERS) -> np.ndarray:
    """One byte per counter: 0 if one word of all texts at most falls to it, else the log of how many.

    Words are counted where they are read; counts travel packed by block of counters and are added block
    by block; the driver gets one byte per counter.
    """

    def count(batches):
        total = np.zeros(counters, dtype=np.int32)
        for batch in batches:
            for _, texts in common.row_blocks(batch.column(0), HASHED):
                words = common.hash_words(texts)[0]
                add_words(total, words)
        blocks, data = [], []
        for low in range(0, counters, PACKED):
            part = total[low: low + PACKED]
            used = np.flatnonzero(part)
            if len(used):
                blocks.append(low // PACKED)
                data.append(used.astype("<u2").tobytes() + part[used].astype("<i4").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(data, pa.binary())], ["block", "data"])

    def add(batches):
        def told():
            codes = code_of(np.maximum(total, 1)).astype(np.uint8)
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([codes.tobytes()])], ["block", "codes"])

        block = None
        for batch in batches:
            for own, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if own != block:
                    if block is not None:
                        yield told()
                    block, total = own, np.zeros(PACKED, dtype=np.int64)
                size = len(data.as_buffer()) // 6
                # The places of one block of counts are distinct.
                total[np.frombuffer(data.as_buffer(), "<u2", size)] += np.frombuffer(data.as_buffer(), "<i4", size, 2 * size)
        if block is not None:
            yield told()

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = docs.select(text).mapInArrow(count, "block int, data binary")
    packed = counted.repartition(parts, "block").sortWithinPartitions("block").mapInArrow(add, "block int, codes binary")
    out = np.zeros(counters, dtype=np.uint8)
    with common.short_batches(docs.sparkSession):
        found = packed.collect()
    for block, codes in found:
        stop = min(counters, (block + 1) * PACKED)
        out[block * PACKED: stop] = np.frombuffer(codes, dtype=np.uint8)[: stop - block * PACKED]
    return out


def _line_sets(texts: pa.Array, codes: np.ndarray, asked=None):
    """Lines with words as sets in the order of rarity: (text, line, size, start), the words, their codes.

    ``asked`` (text, line) restricts them to some lines.
    """
    for low, part in common.row_blocks(texts, HASHED):
        own = None
        if asked is not None:
            inside = (asked[0] >= low) & (asked[0] < low + len(part))
            own = asked[0][inside] - low, asked[1][inside]
        for text, *rest in _block_line_sets(part, codes, own):
            yield text + low, *rest


def _block_line_sets(texts: pa.Array, codes: np.ndarray, asked=None):
    words, first, edges, cuts = common.hash_words(texts, breaks=0x0A)
    offsets = common.flat_bytes(texts)[1]
    owner = np.repeat(np.arange(len(texts)), np.diff(edges))
    number = np.searchsorted(cuts, first) - np.searchsorted(cuts, offsets[:-1])[owner]
    if asked is not None:
        # Lines are numbered over all texts, in order, so a sorted search finds the asked ones.
        before = np.searchsorted(cuts, offsets[:-1])
        wanted = np.sort(before[asked[0]] + asked[0] + asked[1])
        own = before[owner] + owner + number
        held = wanted[np.minimum(np.searchsorted(wanted, own), len(wanted) - 1)] == own if len(wanted) else np.zeros(len(own), bool)
        words, owner, number = words[held], owner[held], number[held]
        edges = np.searchsorted(owner, np.arange(len(texts) + 1))
    low = 0
    while low < len(texts):
        # Whole texts up to SORTED_WORDS words, one at least.
        high = max(int(np.searchsorted(edges, edges[low] + SORTED_WORDS, side="right")) - 1, low + 1)
        part = slice(edges[low], edges[high])
        low = high
        h, text, line = words[part], owner[part], number[part]
        if not len(h):
            continue
        heads = np.append(True, (text[1:] != text[:-1]) | (line[1:] != line[:-1]))
        group = np.cumsum(heads) - 1
        at = np.flatnonzero(heads)
        # One sortable number: the line, the rarity of the word's counter, then bits of its hash.
        bits = max(1, int(len(at) - 1).bit_length())
        code = codes[(h & np.uint64(len(codes) - 1)).astype(np.int64)]
        key = group.astype(np.uint64) << np.uint64(64 - bits)
        key |= code.astype(np.uint64) << np.uint64(56 - bits)
        key |= h >> np.uint64(bits + 8)
        order = np.argsort(key)
        h, group, code = h[order], group[order], code[order]
        new = np.append(True, (h[1:] != h[:-1]) | (group[1:] != group[:-1]))
        h, group, code = h[new], group[new], code[new]
        sizes = np.bincount(group, minlength=len(at))
        yield text[at], line[at], sizes, np.cumsum(sizes) - sizes, h, code


def _sketch(codes, least: int, frequent: int = FREQUENT):
    """text -> its lines with words: (line, n, node, two bitmaps, prefix, frequent).

    An entry of the prefix is a place (upper half) and 32 bits of the word there; ``frequent`` holds
    those of frequent words. A word that occurs once in all texts can be shared with no line, so it is
    left out. Words go to one of the two bitmaps by hash.
    """
    entry = pa.struct([
        ("line", pa.int32()), ("n", pa.int32()), ("node", pa.binary()), ("x", pa.int64()), ("y", pa.int64()),
        ("prefix", pa.list_(pa.int64())), ("frequent", pa.list_(pa.int64())),
    ])

    def of(texts: pa.Array) -> pa.Array:
        owners, columns, sizes_of = [], [[] for _ in range(7)], ([], [])
        for text, line, sizes, starts, h, code in _line_sets(texts, codes.value):
            owners.append(text)
            columns[0].append(line)
            columns[1].append(sizes)
            columns[2].append(common.digests(h, starts))
            bit = np.left_shift(np.uint64(1), h >> np.uint64(58))
            second = ((h >> np.uint64(57)) & np.uint64(1)).astype(bool)
            columns[3].append(np.bitwise_or.reduceat(np.where(second, np.uint64(0), bit), starts))
            columns[4].append(np.bitwise_or.reduceat(np.where(second, bit, np.uint64(0)), starts))
            length = sizes - (least * sizes + 99) // 100 + 1
            place = np.arange(len(h)) - np.repeat(starts, sizes)
            chosen = (place < np.repeat(length, sizes)) & (code > 0)
            entries = (place << 32) | (h & np.uint64(0xFFFFFFFF)).astype(np.int64)
            for part, kept in enumerate((chosen & (code < code_of(frequent)), chosen & (code >= code_of(frequent)))):
                columns[5 + part].append(entries[kept])
                sizes_of[part].append(np.add.reduceat(kept.astype(np.int64), starts))
        if not owners:
            return pa.array([[]] * len(texts), pa.list_(entry))
        owner = np.concatenate(owners)
        flat = [np.concatenate(c) for c in columns]
        rows = pa.StructArray.from_arrays([
            pa.array(flat[0].astype(np.int32)), pa.array(flat[1].astype(np.int32)),
            common.binary16(flat[2], np.arange(len(owner)), len(owner)), pa.array(flat[3].view(np.int64)),
            pa.array(flat[4].view(np.int64)),
            common.lists(flat[5], np.concatenate(sizes_of[0])), common.lists(flat[6], np.concatenate(sizes_of[1])),
        ], names=[f.name for f in entry])
        return pa.ListArray.from_arrays(_ends(owner, len(texts)), rows)

    return F.arrow_udf(of, "array<struct<line:int,n:int,node:binary,x:bigint,y:bigint,prefix:array<bigint>,frequent:array<bigint>>>")


def _ends(owner: np.ndarray, rows: int) -> pa.Array:
    return pa.array(np.searchsorted(owner, np.arange(rows + 1)).astype(np.int32))


def _chosen_sets(codes):
    """(text, lines, cids) -> (cid, set) of the given lines."""

    def of(texts: pa.Array, wanted: pa.Array, cids: pa.Array) -> pa.Array:
        asker = np.repeat(np.arange(len(texts)), np.diff(wanted.offsets.to_numpy()))
        asked = dict(zip(zip(asker.tolist(), wanted.flatten().to_pylist()), cids.flatten().to_pylist()))
        owners, ids, sizes_out, values = [], [], [], []
        places = asker, wanted.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        for text, line, sizes, starts, h, _ in _line_sets(texts, codes.value, places):
            owners.append(text)
            ids.append(np.array([asked[place] for place in zip(text.tolist(), line.tolist())], dtype=np.int64))
            sizes_out.append(sizes)
            values.append(h)
        if not owners:
            return pa.array([[]] * len(texts), pa.list_(pa.struct([("cid", pa.int64()), ("set", pa.list_(pa.int64()))])))
        rows = pa.StructArray.from_arrays([
            pa.array(np.concatenate(ids)), common.lists(np.concatenate(values).view(np.int64), np.concatenate(sizes_out)),
        ], ["cid", "set"])
        return pa.ListArray.from_arrays(_ends(np.concatenate(owners), len(texts)), rows)

    return F.arrow_udf(of, "array<struct<cid:bigint,set:array<bigint>>>")


def _shared(both, least: int):
    """Words that two lines of ``both`` words must have in common: 100 |intersection| >= least |union|, turned round."""
    return (least * both + 99 + least) // (100 + least)


ENTRY = np.dtype([("word", "<u4"), ("pos", "<u4"), ("n", "<u4"), ("id", "<i8"), ("cid", "<i8"), ("x", "<u8"), ("y", "<u8")])


def named_pairs(classes: DataFrame, least: int, parts: int, most: int = CROWDED) -> DataFrame:
    """(cid, other, more, word): pairs under a word that pass all filters, ``other`` read earlier.

    A class names the candidate right before it; ``more`` says that it has others. A word that
    is too crowded gives one row with no ``cid``. Entries travel packed by bucket of words, and a task
    holds one bucket at a time; no word in it is frequent. Under a word, classes are met in the order of
    their sizes, so that those too large to match are never reached.
    """
    buckets = parts * BUCKETS

    def pack(batches):
        def flush(held):
            rows = np.concatenate(held)
            bucket = rows["word"] % np.uint32(buckets)
            order = np.argsort(bucket, kind="stable")
            rows, bucket = rows[order], bucket[order]
            starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            offsets = (np.append(starts, len(rows)) * ENTRY.itemsize).astype(np.int32)
            data = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(rows.view(np.uint8))])
            return pa.RecordBatch.from_arrays([pa.array(bucket[starts].astype(np.int32)), data], ["bucket", "data"])

        held, size = [], 0
        for batch in batches:
            prefix, ids, cid, n, x, y = batch.columns
            sizes = np.diff(prefix.offsets.to_numpy())
            flat = prefix.flatten().to_numpy()
            rows = np.empty(len(flat), dtype=ENTRY)
            rows["word"], rows["pos"] = flat & 0xFFFFFFFF, flat >> 32
            for name, column in (("id", ids.fill_null(-(1 << 63))), ("cid", cid), ("n", n), ("x", x), ("y", y)):
                values = column.to_numpy(zero_copy_only=False)
                rows[name] = np.repeat(values.view(np.uint64) if name in "xy" else values, sizes)
            held.append(rows)
            size += len(rows)
            if size >= PACKED_ENTRIES:
                yield flush(held)
                held, size = [], 0
        if size:
            yield flush(held)

    def compare(rows):
        read = np.lexsort((rows["cid"].copy(), rows["id"].copy()))
        key = rows["word"][read].astype(np.uint64) << np.uint64(32)
        own = rows["n"][read]
        # ``rank`` is the place of an entry in the order of reading.
        rank = np.argsort(key | own, kind="stable")
        key, rows = key[rank], rows[read[rank]]
        word, cid, pos, n = (rows[c].astype(np.int64) for c in ("word", "cid", "pos", "n"))
        x, y = rows["x"].copy(), rows["y"].copy()
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        sizes = np.diff(np.append(starts, len(word)))
        crowded = word[starts[sizes > most]]
        # Entries after each that are under its word and not too large for it.
        reach = np.searchsorted(key | rows["n"], key | (100 * n // least).astype(np.uint64), side="right") - np.arange(len(word)) - 1
        reach[np.repeat(sizes > most, sizes)] = 0
        at = np.argsort(-reach, kind="stable")
        going = np.cumsum(np.bincount(reach)[::-1])[::-1] if len(reach) else []
        count = np.zeros(len(word), dtype=np.int32)
        # The rank of the last candidate before each entry, and its class.
        last, other = np.full(len(word), -1), np.zeros(len(word), dtype=np.int64)
        for step in range(1, len(going)):
            i = at[: going[step]]
            j = i + step
            both = n[i] + n[j]
            shared = _shared(both, least)
            good = np.flatnonzero(np.minimum(n[i] - pos[i], n[j] - pos[j]) >= shared)
            i, j, most_apart = i[good], j[good], both[good] - 2 * shared[good]
            apart = np.bitwise_count(x[i] ^ x[j]).astype(np.int64) + np.bitwise_count(y[i] ^ y[j])
            good = np.flatnonzero((apart <= most_apart) & (cid[i] != cid[j]))
            i, j = i[good], j[good]
            before = rank[i] < rank[j]
            # An entry is at most once on either side of a step.
            for own, earlier in ((j[before], i[before]), (i[~before], j[~before])):
                count[own] += 1
                nearer = rank[earlier] > last[own]
                own, earlier = own[nearer], earlier[nearer]
                last[own], other[own] = rank[earlier], cid[earlier]
        j = np.flatnonzero(count)
        return pa.RecordBatch.from_arrays([
            pa.concat_arrays([pa.array(cid[j]), pa.nulls(len(crowded), pa.int64())]),
            pa.concat_arrays([pa.array(other[j]), pa.nulls(len(crowded), pa.int64())]),
            pa.array(np.append(count[j] > 1, np.zeros(len(crowded), bool))),
            pa.array(np.append(word[j], crowded), mask=np.append(np.ones(len(j), bool), np.zeros(len(crowded), bool))),
        ], ["cid", "other", "more", "word"])

    def run(batches):
        current, held = None, []
        for batch in batches:
            for bucket, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if bucket != current and held:
                    yield compare(np.concatenate(held))
                    held = []
                current = bucket
                held.append(np.frombuffer(data.as_buffer(), dtype=ENTRY))
        if held:
            yield compare(np.concatenate(held))

    packed = classes.where(F.size("prefix") > 0).select("prefix", "rank", "cid", "n", "x", "y").mapInArrow(
        pack, "bucket int, data binary"
    )
    dealt = packed.repartition(parts, "bucket").sortWithinPartitions("bucket")
    found = dealt.mapInArrow(run, "cid bigint, other bigint, more boolean, word bigint")
    return found.groupBy("cid", "other", "word").agg(F.max(F.col("more").cast("int")).alias("more"))


def words_of(entries) -> Column:
    """The words of entries; the place is their upper half."""
    return F.transform(entries, lambda e: e.bitwiseAND(F.lit(0xFFFFFFFF)))


def entries_of(classes: DataFrame, column: str, *more: str) -> DataFrame:
    """One row per entry of ``column``: (word, _id, cid, pos, n, x, y) and the columns ``more``."""
    flat = classes.select(F.explode(column).alias("e"), F.col("rank").alias("_id"), "cid", "n", "x", "y", *more)
    word = F.col("e").bitwiseAND(F.lit(0xFFFFFFFF)).alias("word")
    return flat.select(word, "_id", "cid", F.shiftright("e", 32).cast("int").alias("pos"), "n", "x", "y", *more)


def candidates(later: DataFrame, earlier: DataFrame, least: int, once: bool = False) -> DataFrame:
    """Distinct (cid, other) under a frequent word that pass all filters; ``other`` comes first.

    With ``once``, a pair is made under the first of its words only: the earliest in ``words``, the prefix of
    ``later`` in order, under which ``earlier`` has the other one. A pair that passes by place under a later word passes there.
    The words of the other one are those of its entries ``prefix``, if ``earlier`` has them, else those of its rows.
    """
    known = once and "prefix" in earlier.columns
    hub = earlier.select(
        "word", F.struct("_id", "cid").alias("before"), F.col("cid").alias("other"), F.col("n").alias("m"),
        F.col("pos").alias("at"), F.col("x").alias("u"), F.col("y").alias("v"), *([F.col("prefix").alias("there")] if known else []),
    )
    if once and not known:
        under = earlier.groupBy(F.col("cid").alias("other")).agg(F.collect_set("word").alias("under"))
        hub = lookup(hub, written(under, "line-hubs"), ["other"])
    if fits(later):
        met = hub.join(F.broadcast(later), "word")
    else:
        met = skew_join(later, hub, ["word"])
    both = F.col("n") + F.col("m")
    shared = F.ceil(F.lit(least) * both / F.lit(100 + least))
    apart = F.bit_count(F.col("x").bitwiseXOR(F.col("u"))) + F.bit_count(F.col("y").bitwiseXOR(F.col("v")))
    passing = (
        (F.col("before") < F.struct("_id", "cid"))
        & (F.lit(100) * F.least("n", "m") >= F.lit(least) * F.greatest("n", "m"))
        & (F.least(F.col("n") - F.col("pos"), F.col("m") - F.col("at")) >= shared)
        & (apart <= both - F.lit(2) * shared)
    )
    if once:
        under = words_of(F.col("there")) if known else F.col("under")
        passing &= F.get(F.array_intersect("words", under), F.lit(0)) == F.col("word")
    return met.where(passing).select("cid", "other").distinct()


def settled(pairs: DataFrame, sets_of, least: int) -> DataFrame:
    """(cid): the classes of written pairs (cid, other) that match on their full sets."""
    sets = sets_of(pairs.select("cid").unionAll(pairs.select("other")).distinct())
    # Both sides have one shape, so their exchange is made once.
    left = sets.select(F.col("cid").alias("i"), F.col("set").alias("a"))
    right = sets.select(F.col("cid").alias("j"), F.col("set").alias("b"))
    named = pairs.select(F.col("cid").alias("i"), F.col("other").alias("j"))
    counts = named.groupBy("j").agg(F.count("*").alias("_n"))
    both = skew_join(named.join(left, "i"), right, ["j"], rows=pairs.count(), counts=counts)
    shared = F.size(F.array_intersect("a", "b"))
    union = F.size("a") + F.size("b") - shared
    good = both.where(F.lit(100) * shared >= F.lit(least) * union)
    return written(good.select(F.col("i").alias("cid")).distinct(), "line-matches")


def matches_by_name(
    classes: DataFrame, sets_of, least: int, parts: int, most: int = CROWDED
) -> tuple[DataFrame, DataFrame]:
    """(cid) of classes with an earlier match under a word, and the (word) that are too crowded for it.

    Pairs whose first common word is crowded may be left to that word.
    """
    named = written(named_pairs(classes, least, parts, most), "line-pairs")
    pairs = named.where(F.col("cid").isNotNull())
    crowded = written(named.where(F.col("cid").isNull()).select("word").distinct(), "line-crowded")
    matched = settled(pairs, sets_of, least)
    rest = pairs.where(F.col("more") == 1).select("cid").distinct().join(matched, "cid", "left_anti")
    rest = written(rest, "line-rest")
    if rest.isEmpty():
        return matched, crowded
    own = lookup(classes, rest, ["cid"]).withColumn("words", words_of(F.col("prefix")))
    asking = written(entries_of(own, "prefix", "words").join(broadcast_if_small(crowded), "word", "left_anti"), "line-asking")
    # Prefixes go along where nothing but ``asking`` has to travel for it.
    if fits(asking):
        met = candidates(asking, entries_of(classes, "prefix", "prefix"), least, once=True)
    else:
        met = candidates(asking.drop("words"), entries_of(classes, "prefix"), least)
    fresh = met.join(pairs, ["cid", "other"], "left_anti")
    more = settled(written(fresh, "line-pairs"), sets_of, least)
    return matched.unionByName(more).distinct(), crowded


def matches_in_rounds(members: DataFrame, sets_of, least: int, matched: DataFrame, reach: int = HUBS) -> DataFrame:
    """``matched`` and the (cid) of classes with an earlier match under a frequent word.

    ``members`` is (word, _id, cid, pos, n, x, y, words), written down; ``words`` is the prefix of the class in order.
    """
    first = F.min(F.struct("_id", "cid", "pos", "n", "x", "y"))
    lead = members.groupBy("word").agg(first.alias("h"), F.count("*").alias("size"))
    lead = written(lead.where(F.col("size") > 1).select("word", "h.*", "size"), "line-leads")
    if lead.isEmpty():
        return matched

    def meet(later: DataFrame, hubs: DataFrame, tested: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        pairs = candidates(later, hubs, least, once=True)
        pairs = written(pairs if tested is None else pairs.join(tested, ["cid", "other"], "left_anti"), "line-pairs")
        return pairs, settled(pairs, sets_of, least)

    def and_done(rows: DataFrame) -> DataFrame:
        return written(lookup(rows, matched.withColumn("done", F.lit(True)), ["cid"], "left"), "line-members")

    now = and_done(members)
    tested, more = meet(now.where(F.col("done").isNull()).drop("done"), lead.drop("size"), None)
    matched = written(matched.unionByName(more).distinct(), "line-matches")
    # Two classes under a word have met already.
    left = lookup(members, lead.where(F.col("size") > 2).select("word", "size", F.col("cid").alias("lead")), ["word"])
    # The first class under a word has nothing before it there. It may have gone under another word, so it is
    # told by its number: one other open class is enough to keep the word.
    is_open = F.col("done").isNull() & (F.col("cid") != F.col("lead"))
    while True:
        now = and_done(left)
        open_now = written(lookup(now, now.where(is_open).select("word").distinct(), ["word"]), "open-words")
        if open_now.isEmpty():
            return matched
        share = F.pmod(F.xxhash64("cid", F.lit(7)), F.lit(1 << 20)) / F.lit(float(1 << 20))
        hubs = open_now.where(share * F.col("size") < F.lit(reach))
        tried, more = meet(open_now.where(is_open).drop("done", "size", "lead"), hubs, tested)
        tested = written(tested.unionByName(tried), "tested")
        matched = written(matched.unionByName(more).distinct(), "line-matches")
        # Under words of this size every class has been a hub.
        left = open_now.where(F.col("size") > reach).drop("done")
        reach *= GROWTH


def removed_lines(
    docs: DataFrame, least: int = 80, doc_id: str = "doc_id", text: str = "text", counters: int = COUNTERS,
    frequent: int = FREQUENT, crowded: int = CROWDED, hubs: int = HUBS,
) -> DataFrame:
    """(_id, _ref, removed): numbers from 0, in order, of the lines to remove from each text that loses any.

    ``frequent``, ``crowded`` and ``hubs`` say which words are worked off in rounds and how; they decide speed, not results.
    """
    codes = docs.sparkSession.sparkContext.broadcast(word_rarity(docs, text, counters))
    ident = [F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_ref")]
    sketched = docs.select(*ident, F.explode(_sketch(codes, least, frequent)(F.col(text))).alias("l"))
    lines = written(sketched.select("_id", "_ref", "l.*", F.monotonically_increasing_id().alias("cid")), "lines")
    # One number orders lines wherever they meet: an integer id itself, else the place of the id among all ids.
    if dict(lines.dtypes)["_id"] in ("bigint", "int", "smallint", "tinyint"):
        lines = lines.withColumn("rank", F.col("_id").cast("long"))
    else:
        ids = written(lines.where(F.col("_id").isNotNull()).select("_id").distinct(), "line-ids")
        lines = written(lookup(lines, written(global_index(ids, ["_id"], out="rank"), "line-ranks"), ["_id"], "left"), "lines")
    first = F.min(F.struct("_id", "cid", "_ref", "line"))
    several = lines.groupBy("node").agg(first.alias("lead"), F.count("*").alias("_c")).where(F.col("_c") > 1)
    several = written(several.select("node", "lead"), "line-classes")
    marked = lookup(lines, several, ["node"], "left")
    classes = marked.where(F.col("lead").isNull() | (F.col("cid") == F.col("lead.cid")))

    def sets_of(cids: DataFrame) -> DataFrame:
        asked = lookup(lines.select("cid", "_id", "_ref", "line"), written(cids, "line-cids"), ["cid"])
        ask = asked.groupBy("_id", "_ref").agg(F.collect_list("line").alias("at"), F.collect_list("cid").alias("cids"))
        ask = broadcast_if_small(written(ask, "line-texts"))
        texts = docs.select(F.col(doc_id).alias("own"), F.xxhash64(text).alias("ref"), F.col(text).alias("t"))
        held = texts.join(ask, F.col("own").eqNullSafe(F.col("_id")) & (F.col("ref") == F.col("_ref")))
        found = held.select(F.explode(_chosen_sets(codes)(F.col("t"), F.col("at"), F.col("cids"))).alias("s"))
        return found.select("s.cid", "s.set")

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    matched, full = matches_by_name(classes, sets_of, least, parts, crowded)
    many = entries_of(classes, "frequent", "prefix", "frequent")
    if not full.isEmpty():
        many = many.unionByName(lookup(entries_of(classes, "prefix", "prefix", "frequent"), full, ["word"]))
    ordered = words_of(F.array_sort(F.concat("prefix", "frequent")))
    many = written(many.withColumn("words", ordered).drop("prefix", "frequent"), "line-entries")
    matched = matches_in_rounds(many, sets_of, least, matched, hubs)
    names = lookup(lines.select("cid", "node"), matched, ["cid"]).select("node", F.lit(True).alias("matched"))
    # A repeated row has the place of its first; only lines at another place come later.
    same = F.col("_id").eqNullSafe(F.col("lead._id")) & (F.col("_ref") == F.col("lead._ref")) & (F.col("line") == F.col("lead.line"))
    later = F.col("lead").isNotNull() & ~same
    flagged = lookup(
        marked.select("_id", "_ref", "line", "node", later.alias("later")), written(names, "line-nodes"), ["node"], "left"
    )
    gone = flagged.where(F.col("later") | F.col("matched").isNotNull())
    return written(gone.groupBy("_id", "_ref").agg(F.sort_array(F.collect_set("line")).alias("removed")), "removed-lines")


def dedup_lines(
    docs: DataFrame, least: int = 80, doc_id: str = "doc_id", text: str = "text", out: str = "removed", counters: int = COUNTERS,
    **rounds: int,
) -> DataFrame:
    """``docs`` without repeated lines, and the numbers of the lines that went in the column ``out``.

    A column of that name in ``docs`` is replaced. ``rounds`` are the sizes of ``removed_lines``.
    """
    removed = broadcast_if_small(removed_lines(docs, least, doc_id, text, counters, **rounds))
    # Columns of the input travel in one struct, so that no name can clash.
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != out]).alias("row"),
        F.col(doc_id).alias("own"), F.xxhash64(text).alias("ref"),
    )
    same = F.col("own").eqNullSafe(F.col("_id")) & (F.col("ref") == F.col("_ref"))
    joined = rows.join(removed, same, "left")
    left = F.filter(F.split(F.col("row")[text], "\n"), lambda line, i: ~F.array_contains(F.col("removed"), i))
    changed = F.when(F.col("removed").isNull(), F.col("row")[text]).otherwise(F.array_join(left, "\n"))
    columns = [changed.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns if c != out]
    return joined.select(*columns, F.coalesce("removed", F.array().cast("array<int>")).alias(out))
