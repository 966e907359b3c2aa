"""Prefix tries of conversations, built as burst tries.

A turn is known by 128 bits of its role and text. Equal conversations become one suffix that stands for
all of them. All suffixes begin in one container under the root; a container with more turns than
``capacity`` is burst: the turns that all its suffixes share become a chain of nodes in the trie's head, and
the suffixes go on into one container per next turn. What remains is sorted, container by container, and
swept into nodes: each suffix shares with the one before it the nodes down to their first difference.
Sums over subtrees travel from every container and chain to the chains above it, a row each.

Defined cases: a row without a conversation id belongs to no conversation; a null role or text is empty;
a null turn number comes first; rows of one turn number come in the order of their digests; repeated rows are turns
of their own; an empty table gives no nodes. Columns beside those named are not read. One conversation is one row
(20 bytes a turn, texts apart), however long it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import written
from corpusflow.operators.sizing import broadcast_if_small, lookup

#: Turns that a container may hold; one task sweeps it in memory.
CAPACITY = 1 << 14
#: From this round on the capacity doubles, so that the rounds end however deep shared prefixes fork.
PATIENCE = 16
#: Ids per piece of a joined list.
PIECE = 1 << 16
WORD = r"[^\x20\x09-\x0D]+"

NODE = (
    "conv_id {kind}, depth bigint, parent_conv_id {kind}, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends binary, turn binary, top boolean, heads array<string>"
)


def turn_id(role: Column, text: Column) -> Column:
    """16 bytes that stand for a turn."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))


def sequences(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, seq): the turns of every conversation in order, as (id, words)."""
    words = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("int")
    slim = rows.where(F.col(conv).isNotNull()).select(
        F.col(conv).alias("conv"), F.struct(F.col(turn).alias("turn"), turn_id(F.col(role), F.col(text)).alias("id"), words.alias("words")).alias("t"),
    )
    gathered = slim.groupBy("conv").agg(F.array_sort(F.collect_list("t"), _before).alias("ts"))
    return gathered.select("conv", F.transform("ts", lambda t: F.struct(t["id"], t["words"])).alias("seq"))


def _before(a: Column, b: Column) -> Column:
    """Order of turns: by number, null first, then by digest."""
    x, y = (F.struct(t["turn"], t["id"]) for t in (a, b))
    return F.when(x < y, -1).when(x > y, 1).otherwise(0)


def _whole(seq: Column) -> Column:
    return F.unhex(F.md5(F.array_join(F.transform(seq, lambda t: F.hex(t["id"])), "")))


def _burst(classes: DataFrame, capacity: int) -> tuple[DataFrame, DataFrame | None]:
    """(suffixes in their containers, chains of the trie's head)."""
    now = classes.withColumns({
        "head": F.lit(""), "depth": F.lit(0), "heads": F.array().cast("array<string>"),
        "parent": F.lit(None).cast(classes.schema["least"].dataType),
    })
    settled, chains, rounds = None, None, 0
    add = lambda all_, more: more if all_ is None else all_.unionByName(more)
    while True:
        room = capacity << max(0, rounds - PATIENCE)
        sizes = now.groupBy("head").agg(F.count("*").alias("c"), F.sum(F.size("seq") - F.col("depth") + 1).alias("turns"))
        over = written(sizes.where((F.col("c") > 1) & (F.col("turns") > room)).select("head"), "over")
        if over.isEmpty():
            return add(settled, now), chains
        mark = broadcast_if_small(over.withColumn("burst", F.lit(True)))
        full = now.join(mark, "head", "left_semi")
        shared = full.groupBy("head").agg(
            F.min("least").alias("conv"), F.sum("m").alias("n"), F.min("seq").alias("low"), F.max("seq").alias("high"),
            F.first("depth").alias("depth"), F.first("heads").alias("heads"), F.first("parent").alias("parent"),
        )
        same = F.zip_with("low", "high", lambda a, b: a.eqNullSafe(b))
        chain = written(
            shared.withColumn("last", F.array_position(same, False).cast("int") - 1).select(
                "head", "heads", "parent", "conv", "n", "depth", "last",
                F.slice("low", F.greatest(F.col("depth"), F.lit(1)), F.col("last") - F.greatest(F.col("depth"), F.lit(1)) + 1).alias("turns"),
            ), "chains",
        )
        settled = add(settled, now.join(mark, "head", "left_anti"))
        gone = written(lookup(full, chain.select("head", "last", "conv"), ["head"]), "burst")
        go_on = gone.where(F.size("seq") > F.col("last"))
        step = F.get("seq", F.col("last"))["id"]
        now = written(go_on.select(
            "whole", "least", "m", "seq", F.md5(F.concat(F.col("head"), F.hex(step), F.col("last").cast("string"))).alias("to"),
            (F.col("last") + 1).alias("depth"), F.array_append("heads", F.col("head")).alias("heads"), F.col("conv").alias("parent"),
            F.col("head").alias("from"),
        ).withColumnRenamed("to", "head"), "containers")
        below = now.groupBy("from", "head").count().groupBy("from").agg(F.count("*").alias("children"))
        ends = gone.where(F.size("seq") == F.col("last")).select(F.col("head").alias("from"), F.col("whole").alias("ends"))
        now = now.drop("from")
        grown = chain.join(below, chain["head"] == below["from"]).drop("from")
        chains = add(chains, grown.join(ends, grown["head"] == ends["from"], "left").drop("from"))
        rounds += 1


def _swept(contained: DataFrame, kind: str) -> DataFrame:
    """Nodes of all containers."""
    names = [part.strip().split(" ")[0] for part in NODE.split(", ")]
    least_type = contained.schema["least"].dataType

    def container(depth, heads, parent, seqs, words, least, m, whole, out):
        """The nodes of one container, its suffixes being sorted; a parent comes before its children."""
        up, deep, ids, size = [-1], [depth], [seqs[0][depth - 1] if depth else None], [words[0][depth - 1] if depth else 0]
        n, low, ends = [0], [None], [None]
        stack, before = [0], None
        for seq, own, conv, many, key in zip(seqs, words, least, m, whole):
            same = depth
            if before is not None:
                most = min(len(seq), len(before))
                while same < most and seq[same] == before[same]:
                    same += 1
            del stack[same - depth + 1:]
            for d in range(same, len(seq)):
                up.append(stack[-1])
                deep.append(d + 1)
                ids.append(seq[d])
                size.append(own[d])
                n.append(0)
                low.append(None)
                ends.append(None)
                stack.append(len(up) - 1)
            at = stack[-1]
            n[at] += many
            low[at] = conv
            ends[at] = key
            before = seq
        children, leaves, saved = [0] * len(up), [0] * len(up), [0] * len(up)
        for i in range(len(up) - 1, -1, -1):
            leaves[i] = leaves[i] or 1
            saved[i] += (n[i] - 1) * size[i]
            j = up[i]
            if j >= 0:
                children[j] += 1
                leaves[j] += leaves[i]
                saved[j] += saved[i]
                n[j] += n[i]
                low[j] = low[i] if low[j] is None else min(low[j], low[i])
        above = [parent if j < 0 else low[j] for j in up]
        first = [True] + [False] * (len(up) - 1)
        own_heads = [heads] + [None] * (len(up) - 1)
        for column, more in zip(out, (low, deep, above, n, children, leaves, saved, ends, ids, first, own_heads)):
            column.extend(more)

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        id_type = to_arrow_type(least_type)
        types = [id_type, pa.int64(), id_type, *[pa.int64()] * 4, pa.binary(), pa.binary(), pa.bool_(), pa.list_(pa.string())]
        out: list[list] = [[] for _ in types]
        now, held = None, None

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)

        for batch in batches:
            for head, depth, heads, parent, ids, words, least, m, whole in zip(*(c.to_pylist() for c in batch.columns)):
                if head != now:
                    if held is not None:
                        container(*held, out)
                        if len(out[0]) >= PIECE:
                            yield rows()
                            out = [[] for _ in types]
                    now, held = head, (depth, heads, parent, [], [], [], [], [])
                for column, value in zip(held[3:], (ids, words, least, m, whole)):
                    column.append(value)
        if held is not None:
            container(*held, out)
        if out[0]:
            yield rows()

    parts = int(contained.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = contained.repartition(parts, "head").sortWithinPartitions("head", "seq").select(
        "head", "depth", "heads", "parent", F.col("seq")["id"].alias("ids"), F.col("seq")["words"].alias("words"), "least", "m", "whole",
    )
    return ordered.mapInArrow(sweep, NODE.format(kind=kind))


def _chained(chains: DataFrame, kind: str) -> DataFrame:
    """The nodes of chains, ``leaves`` and ``saved`` being the sums of what hangs below them."""
    names = [part.strip().split(" ")[0] for part in NODE.split(", ")]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                depth, last, n = (row[c].as_py() for c in ("depth", "last", "n"))
                size = last - depth + 1
                words, ids = row["words"].as_py(), row["ids"].as_py()
                if depth == 0:
                    words, ids = [0, *words], [None, *ids]
                own = (n - 1) * np.array(words, dtype=np.int64)
                saved = row["saved"].as_py() + np.cumsum(own[::-1])[::-1]
                conv = batch.column("conv").slice(i, 1)
                same = pa.concat_arrays([conv] * size)
                full = lambda value: pa.array(np.full(size, value, np.int64))
                children = np.ones(size, np.int64)
                children[-1] = row["children"].as_py()
                yield pa.RecordBatch.from_arrays([
                    same, pa.array(np.arange(depth, last + 1)), pa.concat_arrays([batch.column("parent").slice(i, 1), same.slice(1)]),
                    full(n), pa.array(children), full(row["leaves"].as_py()), pa.array(saved),
                    pa.array([None] * (size - 1) + [row["ends"].as_py()], pa.binary()), pa.array(ids, pa.binary()),
                    pa.array([False] * size), pa.nulls(size, pa.list_(pa.string())),
                ], names)

    slim = chains.select(
        "conv", "parent", "n", "depth", "last", "children", "leaves", "saved", "ends",
        F.col("turns")["id"].alias("ids"), F.col("turns")["words"].alias("words"),
    )
    return slim.mapInArrow(spread, NODE.format(kind=kind))


def joined_digests(members: DataFrame, key: str, value: str) -> DataFrame:
    """(key, sha256): SHA-256 of the values of each key, ascending, as text with commas between.

    Values are sorted by ranges and joined piece by piece, so that a key of any size is spread over tasks; only its
    pieces' texts pass through one hash, one after the other.
    """
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = members.schema[value].dataType.simpleString()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, names = (batch.column(i).to_pylist() for i in (0, 2))
            starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
            cuts = [c for a, b in zip(starts, [*starts[1:], len(keys)]) for c in range(a, b, PIECE)]
            ends = [*cuts[1:], len(keys)]
            yield pa.RecordBatch.from_arrays([
                pa.array([keys[i] for i in cuts], pa.binary()), batch.column(1).take(pa.array(cuts, pa.int64())),
                pa.array([",".join(names[a:b]) for a, b in zip(cuts, ends)], pa.string()),
            ], ["key", "first", "piece"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        row = lambda: pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], ["key", "sha256"])
        for batch in batches:
            done: list[tuple] = []
            for at, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if state is None or at != now:
                    if state is not None:
                        done.append((now, state.hexdigest()))
                    now, state = at, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(piece.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done])], ["key", "sha256"])
        if state is not None:
            yield row()

    slim = members.select(F.col(key).alias("key"), F.col(value).alias("value"))
    ranged = slim.repartitionByRange(parts, "key", "value").sortWithinPartitions("key", "value")
    pieces = ranged.select("key", "value", F.col("value").cast("string").alias("name")).mapInArrow(join, f"key binary, first {kind}, piece string")
    return pieces.repartition(parts, "key").sortWithinPartitions("key", "first").mapInArrow(digest, "key binary, sha256 string")


def nodes(seqs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The nodes of the trie of (conv, seq): conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves and saved_tokens of the subtree, ends_sha256 (of those that end here), turn (id of the last turn)."""
    kind = seqs.schema["conv"].dataType.simpleString()
    members = written(seqs.withColumn("whole", _whole(F.col("seq"))), "sequences")
    classes = written(
        members.groupBy("whole").agg(F.min("conv").alias("least"), F.count("*").alias("m"), F.first("seq").alias("seq")), "suffixes",
    )
    contained, chains = _burst(classes, capacity)
    found = written(_swept(contained, kind), "swept")
    if chains is not None:
        chains = written(chains, "chains")
        own = (F.col("n") - 1) * F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + t["words"])
        # A chain that does not begin at the root begins with its own first node, whose turn ``turns`` holds.
        said = chains.select(F.explode("heads").alias("head"), F.lit(0).cast("long").alias("leaves"), own.alias("saved"))
        told = found.where("top").select(F.explode("heads").alias("head"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
        sums = said.unionByName(told).groupBy("head").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        found = found.unionByName(_chained(chains.join(sums, "head"), kind))
    ends = joined_digests(members, "whole", "conv").withColumnRenamed("key", "ends")
    none = hashlib.sha256(b"").hexdigest()
    return found.join(ends, "ends", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("sha256", F.lit(none)).alias("ends_sha256"), "turn",
    )


def with_shared_starts(seqs: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations that begin with the first turns of another: of conversation ``c - c % every`` the first
    ``crc32(c) % most``, then their own turns after as many."""
    c = F.col("conv")
    h = F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(most)).cast("int")
    starts = seqs.where(c % every == 0).select(c.alias("_base"), F.slice("seq", 1, most - 1).alias("_start"))
    none = F.slice("seq", 1, 0)
    start = F.slice(F.coalesce("_start", none), F.lit(1), F.col("_h"))
    rest = F.slice("seq", F.col("_h") + 1, F.greatest(F.size("seq") - F.col("_h"), F.lit(0)))
    joined = seqs.withColumns({"_base": c - c % every, "_h": h}).join(starts, "_base", "left")
    return joined.select("conv", F.concat(start, rest).alias("seq"))


def turn_texts(rows: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """(turn, role, text) of every distinct turn, to read nodes by."""
    role, text = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    return rows.select(turn_id(role, text).alias("turn"), role.alias("role"), text.alias("text")).dropDuplicates(["turn"])


def prefix_trie(rows: DataFrame, names: Sequence[str] = ("conv_id", "turn", "role", "text"), capacity: int = CAPACITY) -> DataFrame:
    """The trie of the conversations as they are."""
    return nodes(sequences(rows, *names), capacity)
