"""Repeated passages by sparse suffix arrays.

Only suffixes at content-selected positions are kept: of every 25 neighbouring word 8-grams the one with
the least hash. Two equal passages of 50 words select the same positions, and the 26 words from such a
position on lie inside the passage. Suffixes are sorted by the hash of those words and compared with their
neighbours; the few that have an equal are extended to the left and to the right, to every passage of 50
words that selected them, and these are sorted and compared again. Overlapping passages that occur twice
anywhere grow together into maximal spans.

Nothing is lost: a passage of ``LENGTH`` words is reported exactly if it occurs at two places (in two
rows, or twice in one text). Records travel packed. Equal records that meet in one task are reported there
and send one record on, so that a passage that a third of all texts share does not land in one task.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+`` with A-Z as a-z; a text of fewer words, an empty and a null
text have no spans; rows with equal texts (also repeated rows) are repeats of each other as a whole; ids
are passed through, null or not. Columns beside id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import common, exchange
from corpusflow.llm.common import written
from corpusflow.operators.sizing import broadcast_if_small, skew_join

LENGTH, WINDOW, GRAM = 50, 25, 8
KEY = LENGTH - WINDOW + 1
#: Words of texts that are handled together.
BLOCK = 1 << 18

#: A place in a text (96 bits of its digest), with a hash or without.
PLACE = np.dtype([("a", "<u8"), ("b", "<u4"), ("at", "<u4")])
RECORD = np.dtype([("h", "<u8"), ("a", "<u8"), ("b", "<u4"), ("at", "<u4"), ("flag", "u1")])
SINGLE, KNOWN, FOUND = 0, 1, 2


def text_ref(text: Column) -> Column:
    """96 bits of a text's digest."""
    return F.unhex(F.substring(F.md5(text), 1, 24))


def _spans_hash(words: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each start, from running sums."""
    powers, inverses = common._tables(len(words) + 1)
    running = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * powers[: len(words)], dtype=np.uint64)))
    return common.mix64((running[starts + size] - running[starts]) * inverses[starts])


def _selected(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all passages of LENGTH words inside one text, and the position each selects."""
    if len(words) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.flatnonzero(owner[: len(words) - LENGTH + 1] == owner[LENGTH - 1:])
    grams = _spans_hash(words, np.arange(len(words) - GRAM + 1), GRAM)
    least = np.empty(len(start), dtype=np.int64)
    view = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)
    for low in range(0, len(start), 1 << 14):
        part = start[low: low + (1 << 14)]
        least[low: low + (1 << 14)] = view[part].argmin(axis=1)
    return start, start + least


def _refs(column: pa.Array) -> np.ndarray:
    """The 12-byte digests of a column without nulls as (a, b)."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, dtype=np.dtype([("a", "<u8"), ("b", "<u4")]))


def _texts(batch: pa.RecordBatch):
    """(hashed words, their text's row, where the texts begin, first row) of runs of texts of a batch (ref, text, …)."""
    texts = batch.column(1)
    words, _, edges, _ = common.hash_words(texts)
    low = 0
    while low < len(texts):
        high = max(int(np.searchsorted(edges, edges[low] + BLOCK, side="right")) - 1, low + 1)
        high = min(high, len(texts))
        part = words[edges[low]: edges[high]]
        yield part, np.repeat(np.arange(low, high), np.diff(edges[low: high + 1])), edges, low
        low = high


def _records(h: np.ndarray, refs: np.ndarray, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.zeros(len(h), dtype=RECORD)
    out["h"], out["a"], out["b"], out["at"] = h, refs["a"][rows], refs["b"][rows], at
    return out


def _pack_records(buckets: int):
    """Records sorted and compared where they are; equal ones are found here and send one on."""

    def pack(rows: np.ndarray) -> pa.RecordBatch:
        rows = rows[np.argsort(rows["h"], kind="stable")]
        heads = np.append(True, rows["h"][1:] != rows["h"][:-1])
        starts = np.flatnonzero(heads)
        sizes = np.diff(np.append(starts, len(rows)))
        many = np.repeat(sizes > 1, sizes)
        known = rows[starts[sizes > 1]]
        known["flag"] = KNOWN
        found = np.unique(rows[many])
        found["flag"] = FOUND
        out = np.concatenate([rows[~many], known, found])
        spread = np.where(out["flag"] == FOUND, common.mix64(out["a"] + out["at"]), out["h"])
        return exchange.block(out, spread % np.uint64(buckets))

    return pack


def _places_found(rows: np.ndarray) -> np.ndarray:
    """Places of one bucket's records that have an equal neighbour in sorted order."""
    found = rows[rows["flag"] == FOUND]
    rest = rows[rows["flag"] != FOUND]
    rest = rest[np.argsort(rest["h"], kind="stable")]
    if len(rest):
        starts = np.flatnonzero(np.append(True, rest["h"][1:] != rest["h"][:-1]))
        sizes = np.diff(np.append(starts, len(rest)))
        equal = (sizes > 1) | (np.maximum.reduceat(rest["flag"], starts) == KNOWN)
        found = np.concatenate([found, rest[np.repeat(equal, sizes) & (rest["flag"] == SINGLE)]])
    out = np.empty(len(found), dtype=PLACE)
    for name in PLACE.names:
        out[name] = found[name]
    return out


def _repeated(packed: DataFrame, parts: int, answer) -> DataFrame:
    """``answer`` of all repeated places of each text, from packed records."""
    buckets = parts * exchange.BUCKETS

    def find(batches):
        places = (_places_found(rows) for rows in exchange.by_bucket(batches, RECORD))

        def pack(rows):
            rows = np.unique(rows)
            return exchange.block(rows, common.mix64(rows["a"].copy()) % np.uint64(buckets))

        yield from exchange.gathered((p for p in places if len(p)), pack)

    def by_text(batches):
        for rows in exchange.by_bucket(batches, PLACE):
            rows = np.unique(rows)
            heads = np.append(True, (rows["a"][1:] != rows["a"][:-1]) | (rows["b"][1:] != rows["b"][:-1]))
            starts = np.flatnonzero(heads)
            refs = np.empty(len(starts), dtype=[("a", "<u8"), ("b", "<u4")])
            refs["a"], refs["b"] = rows["a"][starts], rows["b"][starts]
            raw = refs.tobytes()
            values = [answer(part) for part in np.split(rows["at"], starts[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([raw[i: i + 12] for i in range(0, len(raw), 12)], pa.binary()), pa.array(values, pa.binary())],
                ["ref", "places"],
            )

    found = exchange.dealt(packed, parts).mapInArrow(find, exchange.PACKED)
    return exchange.dealt(found, parts).mapInArrow(by_text, "ref binary, places binary")


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, start, end, n_words): maximal spans of words covered by passages that occur more than once."""
    parts = exchange.partitions(docs)
    buckets = parts * exchange.BUCKETS
    texts = docs.where(F.col(text).isNotNull()).select(text_ref(F.col(text)).alias("ref"), F.col(text).alias("t"))

    def suffixes(batches):
        def parts_of():
            for batch in batches:
                refs = _refs(batch.column(0))
                for words, owner, edges, _ in _texts(batch):
                    picked = np.unique(_selected(words, owner)[1])
                    if len(picked):
                        rows = owner[picked]
                        base = edges[owner[0]]
                        yield _records(_spans_hash(words, picked, KEY), refs, rows, picked + base - edges[rows])

        yield from exchange.gathered(parts_of(), _pack_records(buckets))

    def passages(batches):
        def parts_of():
            for batch in batches:
                refs, places = _refs(batch.column(0)), batch.column(2)
                for words, owner, edges, _ in _texts(batch):
                    start, picked = _selected(words, owner)
                    if not len(start):
                        continue
                    base = edges[owner[0]]
                    own = np.unique(owner)
                    wanted = np.concatenate([
                        np.frombuffer(places[int(r)].as_buffer(), dtype="<u4").astype(np.int64) + edges[r] - base for r in own
                    ])
                    start = start[np.isin(picked, wanted)]
                    if len(start):
                        rows = owner[start]
                        yield _records(_spans_hash(words, start, LENGTH), refs, rows, start + base - edges[rows])

        yield from exchange.gathered(parts_of(), _pack_records(buckets))

    def places_of(at: np.ndarray) -> bytes:
        return at.astype("<u4").tobytes()

    def spans_of(at: np.ndarray) -> bytes:
        at = at.astype(np.int64)
        breaks = np.flatnonzero(np.append(True, np.diff(at) > LENGTH))
        ends = at[np.append(breaks[1:], len(at)) - 1] + LENGTH
        return np.stack([at[breaks], ends], axis=1).astype(">u4").tobytes()

    picked = _repeated(texts.mapInArrow(suffixes, exchange.PACKED), parts, places_of)
    picked = broadcast_if_small(written(picked, "repeat-suffixes"))
    again = texts.join(picked, "ref").select("ref", "t", "places")
    spans = written(_repeated(again.mapInArrow(passages, exchange.PACKED), parts, spans_of), "repeat-spans")
    # Eight bytes per span, as hexadecimal digits.
    digits = F.hex("places")
    count = (F.length(digits) / 16).cast("int")

    def number(i: Column, shift: int) -> Column:
        return F.conv(F.substr(digits, i * F.lit(16) + F.lit(1 + shift), F.lit(8)), 16, 10).cast("long")

    listed = F.transform(
        F.sequence(F.lit(0), count - 1), lambda i: F.struct(number(i, 0).alias("start"), number(i, 8).alias("end"))
    )
    named = spans.select("ref", listed.alias("spans"))
    rows = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("_id"), text_ref(F.col(text)).alias("ref"))
    met = skew_join(written(rows, "repeat-rows"), named, ["ref"])
    return met.select(F.col("_id").alias(doc_id), F.explode("spans").alias("s")).select(
        doc_id, "s.start", "s.end", (F.col("s.end") - F.col("s.start")).alias("n_words")
    )
