"""Histogram sort of documents into shards of nearly equal bytes.

Documents are ordered by (hash of the text, hash of the id, place in the written table). Copies of a
text are neighbours, so they share a shard unless a boundary has to run through a large group of them.
Rounds of exact histograms count the bytes of all documents below candidate boundaries; only the
interval in which a boundary must lie is probed again, more finely, until every boundary meets the
tolerance. The driver sees at most ``(shards - 1) * 256`` counts of a round after the first 65,536.
Rows are exchanged once, when their boundaries are known, by narrow ranges of the order rather than by
shard, so that a shard of any size is numbered by many tasks.

Defined cases: a null text has no bytes (size 1 with the row's own) and a null checksum; a null id is
one more id; repeated rows are rows of their own; an empty table gives no rows; a table with fewer
rows than shards leaves shards empty. Columns beside id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import written

#: Width in hexadecimal digits of an order key: three 64-bit words.
DIGITS = 48
FIRST_DIGITS, MORE_DIGITS = 4, 2
TOLERANCE = 0.001
#: A range of the order is numbered by one task; one with more rows than this share of all is cut.
RANGE_SHARE, RANGE_LEAST = 1e-4, 1024


def _hex(number: Column) -> Column:
    return F.lpad(F.hex(number), 16, "0")


def slim(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, size, text_crc32, key), written down: texts are read once."""
    content = F.col(text)
    rows = docs.select(
        F.col(doc_id).alias("_id"),
        (F.coalesce(F.octet_length(content), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        F.concat(
            _hex(F.xxhash64(content)), _hex(F.xxhash64(F.col(doc_id).cast("string"))),
            _hex(F.monotonically_increasing_id()),
        ).alias("key"),
    )
    return written(rows, "shards")


def _histogram(rows: DataFrame, open_nodes: list[str], digits: int) -> dict[str, list[tuple[str, int, int, str]]]:
    """For each open prefix: its children in order as (prefix, bytes, rows, longest common prefix)."""
    depth = len(open_nodes[0]) if open_nodes else 0
    counted = rows
    if depth:
        counted = rows.where(F.substring("key", 1, depth).isin(open_nodes))
    found = counted.groupBy(F.substring("key", 1, depth + digits).alias("node")).agg(
        F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.min("key").alias("low"), F.max("key").alias("high")
    )
    out: dict[str, list] = {node: [] for node in open_nodes}
    for node, size, count, low, high in sorted(found.collect()):
        common = next((i for i, (x, y) in enumerate(zip(low, high)) if x != y), DIGITS)
        out[node[:depth]].append((node, size, count, low[:common]))
    return out


def splitters(rows: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[str]:
    """Keys at which the shards 1 to ``shards - 1`` begin: shard ``i`` holds keys from splitter ``i - 1``."""
    tops = _histogram(rows, [""], FIRST_DIGITS)[""]
    total = sum(t[1] for t in tops)
    found: list[str | None] = [None] * (shards - 1)
    slack = tolerance * total / shards
    # Per boundary: the bytes still to be passed inside the children that are being looked at.
    asked = {i: (tops, (i + 1) * total / shards) for i in range(shards - 1)}
    while asked:
        probe: dict[int, tuple[tuple[str, int, int, str], float]] = {}
        for i, (children, target) in asked.items():
            if not children:
                found[i] = ""
                continue
            below = 0
            for j, child in enumerate(children):
                after = below + child[1]
                if after >= target:
                    break
                below = after
            # The boundary lies inside ``child``; either end will do if it is near enough.
            following = children[j + 1][0] if j + 1 < len(children) else _after(child[0])
            if min(target - below, after - target) <= slack or child[2] == 1 or len(child[3]) == DIGITS:
                found[i] = child[0] if target - below <= after - target else following
            else:
                probe[i] = (child, target - below)
        if not probe:
            break
        # The common prefix of all keys inside an interval needs no probing.
        by_depth: dict[int, set[str]] = {}
        for child, _ in probe.values():
            by_depth.setdefault(len(child[3]), set()).add(child[3])
        children_of: dict[str, list] = {}
        for nodes in by_depth.values():
            children_of |= _histogram(rows, sorted(nodes), MORE_DIGITS)
        asked = {i: (children_of[child[3]], rest) for i, (child, rest) in probe.items()}
    return [s or "" for s in found]


def _after(prefix: str) -> str:
    """The least string above every key that begins with ``prefix``."""
    return prefix + "G"


def shard_of(key: Column, cuts: list[str]) -> Column:
    """How many splitters are not above the key."""
    out = F.lit(0)
    for cut in cuts:
        out = out + (key >= F.lit(cut)).cast("int")
    return out


def shard_by_bytes(
    docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text", tolerance: float = TOLERANCE
) -> DataFrame:
    """(id, size, text_crc32, shard, slot): shards of nearly equal bytes, slots without gaps from 0."""
    rows = slim(docs, doc_id, text)
    cuts = splitters(rows, shards, tolerance)
    placed = rows.withColumn("shard", shard_of(F.col("key"), cuts))
    n = rows.count()
    most = max(RANGE_LEAST, int(n * RANGE_SHARE))
    # Narrow ranges of the order: the first digits, and for crowded ones the leading digits of the
    # second word (the ids of one text) and the third.
    narrow = placed.groupBy(F.substring("key", 1, FIRST_DIGITS).alias("top")).agg(F.count("*").alias("n"))
    hot = F.broadcast(narrow.where(F.col("n") > most).select("top", F.lit(True).alias("hot")))
    placed = placed.withColumn("top", F.substring("key", 1, FIRST_DIGITS)).join(hot, "top", "left")
    spread = F.substring("key", 1, 16 + FIRST_DIGITS)
    placed = placed.withColumn("range", F.when(F.col("hot"), spread).otherwise(F.col("top"))).drop("top", "hot")
    sizes = placed.groupBy("shard", "range").agg(F.count("*").alias("n"))
    running = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "range", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "range").orderBy("key")) - 1
    return (
        placed.withColumn("_in", inside)
        .join(offsets, ["shard", "range"])
        .select(F.col("_id").alias(doc_id), "size", "text_crc32", "shard", (F.col("before") + F.col("_in")).alias("slot"))
    )
