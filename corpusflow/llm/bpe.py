"""BPE encoding and decoding by speculation and verification.

A word is first cut greedily into the longest tokens. That is what merging would give exactly when every
token can be built by merging and every two neighbours are compatible, that is, no merge across their
border comes before a merge inside them; all pairs of all new words are tested together on arrays. Only
words that fail are merged step by step. Texts are cut into words as the vocabulary file says; distinct
words are encoded once per cache.

The vocabulary is a public tokenizer file (a parameter); it is read by the driver and sent to the tasks.

Defined cases: a null text is empty and has no tokens; special strings in a text are their special tokens;
no tokens decode to an empty text; an unknown id raises. Letters that are newer than Unicode 15.1, the
version of Python's tables, may be cut or lower-cased differently from other libraries. Decoding joins the tokens' names by blanks, which is
what the file defines. Columns beside the text are passed through by the caller.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

#: Distinct words kept by a task before it forgets them all.
CACHED_WORDS = 1 << 17
#: Bytes of texts that are cut into words together.
BLOCK = 1 << 20
NEVER = np.iinfo(np.int64).max


def byte_names() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {chr(b): b for b in shown}
    rest = [b for b in range(256) if b not in set(shown)]
    return names | {chr(256 + i): b for i, b in enumerate(rest)}


def load(path: str) -> dict:
    """The tables of a BPE vocabulary with word ends, from a tokenizer file."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    model, end = told["model"], told["model"]["end_of_word_suffix"]
    vocab, names = model["vocab"], byte_names()
    size = max([*vocab.values(), *(t["id"] for t in told["added_tokens"])]) + 1
    text = [""] * size
    for name, token in vocab.items():
        text[token] = name
    specials = {t["content"]: t["id"] for t in told["added_tokens"]}
    for name, token in specials.items():
        text[token] = name
    inner, final = {}, {}
    for name, token in vocab.items():
        last = name.endswith(end)
        raw = bytes(names[c] for c in (name[: -len(end)] if last else name))
        (final if last else inner)[raw] = token
    # Order of tokens: single bytes first, then by the merge that makes them.
    rank = np.full(size, -1, dtype=np.int64)
    left, right = np.full(size, -1, dtype=np.int64), np.full(size, -1, dtype=np.int64)
    pairs, twice = [], set()
    for i, merge in enumerate(model["merges"]):
        a, b = merge if isinstance(merge, list) else merge.split(" ")
        token = vocab[a + b]
        pairs.append((vocab[a], vocab[b], i, token))
        if rank[token] >= 0:
            twice.add(token)
        else:
            rank[token], left[token], right[token] = i, vocab[a], vocab[b]
    merges = np.array(sorted(pairs), dtype=np.int64)
    out = {
        "text": text, "specials": specials, "inner": inner, "final": final, "rank": rank, "left": left, "right": right,
        "pair": (merges[:, 0] << 32) | merges[:, 1], "pair_rank": merges[:, 2],
        "merge": {(a, b): (i, token) for a, b, i, token in pairs},
    }
    out["sound"] = _sound(out, twice)
    # The longest token that begins with two given bytes; a single byte alone ends a word.
    reach: dict[bytes, int] = {}
    for raw in chain(inner, final):
        reach[raw[:2]] = max(reach.get(raw[:2], 1), len(raw))
    out["reach"] = reach
    return out


def _crossing(tables: dict, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rank of the merge of each pair of tokens; NEVER where there is none."""
    key = (a << 32) | b
    at = np.minimum(np.searchsorted(tables["pair"], key), len(tables["pair"]) - 1)
    return np.where(tables["pair"][at] == key, tables["pair_rank"][at], NEVER)


def compatible(tables: dict, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
    """Whether merging the bytes of ``a`` and ``b`` on end gives just these two tokens, pair by pair.

    Merges are undone from the last one on. Whenever the border lies between two parts, a merge over it that
    comes before the merges still to be undone would have happened. Each part must be sound by itself.
    """
    rank, left, right = tables["rank"], tables["left"], tables["right"]
    out = np.ones(len(a), dtype=bool)
    at = np.arange(len(a))
    a, b = a.copy(), b.copy()
    limit = np.full(len(a), NEVER) if limit is None else limit.copy()
    while len(at):
        bad = _crossing(tables, a, b) < limit
        out[at[bad]] = False
        ra, rb = rank[a], rank[b]
        going = ~bad & ((ra >= 0) | (rb >= 0))
        at, a, b, ra, rb, limit = (v[going] for v in (at, a, b, ra, rb, limit))
        # Undo the later merge. Of equal merges the left one happens first, so a merge over the border
        # of the same rank as the right part's wins against it.
        of_left = ra > rb
        limit = np.where(of_left, ra, rb + 1)
        a, b = np.where(of_left, right[a], a), np.where(of_left, b, left[b])
    return out


def _sound(tables: dict, twice: set[int]) -> np.ndarray:
    """Which tokens merging builds from their own bytes."""
    rank, left, right = tables["rank"], tables["left"], tables["right"]
    sound = rank < 0
    made = np.flatnonzero(rank >= 0)
    whole = compatible(tables, left[made], right[made], rank[made])
    for token, good in sorted(zip(made.tolist(), whole.tolist()), key=lambda t: rank[t[0]]):
        sound[token] = good and sound[left[token]] and sound[right[token]] and token not in twice
    return sound


def greedy(tables: dict, word: bytes) -> list[int]:
    """The longest token at each place; tokens that reach the end are word ends."""
    inner, final, reach = tables["inner"], tables["final"], tables["reach"]
    out, at, size = [], 0, len(word)
    while at < size:
        most = reach.get(word[at: at + 2], 1)
        if size - at <= most and word[at:] in final:
            out.append(final[word[at:]])
            break
        stop = min(size - 1, at + most)
        while stop > at + 1 and word[at:stop] not in inner:
            stop -= 1
        out.append(inner[word[at:stop]])
        at = stop
    return out


def merged(tables: dict, word: bytes) -> list[int]:
    """Exact merging, the lowest rank first and leftmost among equals."""
    inner, final, merge = tables["inner"], tables["final"], tables["merge"]
    parts = [inner[word[i: i + 1]] for i in range(len(word) - 1)] + [final[word[-1:]]]
    none = (NEVER, -1)
    ways = [merge.get(pair, none) for pair in zip(parts, parts[1:])]
    while ways:
        best = min(ways)
        if best is none:
            break
        i = ways.index(best)
        parts[i: i + 2] = [best[1]]
        del ways[i]
        if i:
            ways[i - 1] = merge.get((parts[i - 1], parts[i]), none)
        if i < len(ways):
            ways[i] = merge.get((parts[i], parts[i + 1]), none)
    return parts


def encode_words(tables: dict, words: list[bytes]) -> list[list[int]]:
    """Tokens of each word: proposed, tested together, and merged exactly where a test fails."""
    proposed = [greedy(tables, word) for word in words]
    sizes = np.fromiter(map(len, proposed), dtype=np.int64, count=len(proposed))
    flat = np.fromiter(chain.from_iterable(proposed), dtype=np.int64, count=int(sizes.sum()))
    owner = np.repeat(np.arange(len(words)), sizes)
    failed = np.zeros(len(words), dtype=bool)
    failed[owner[~tables["sound"][flat]]] = True
    inside = np.flatnonzero(owner[1:] == owner[:-1])
    if len(inside):
        keys, back = np.unique((flat[inside] << 32) | flat[inside + 1], return_inverse=True)
        good = compatible(tables, keys >> 32, keys & 0xFFFFFFFF)
        failed[owner[inside[~good[back]]]] = True
    for i in np.flatnonzero(failed).tolist():
        proposed[i] = merged(tables, words[i])
    return proposed


# How the vocabulary file cuts a normalised text into words (fixed values).
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
_ASCII = re.compile(_ENDINGS + r"|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
_UNICODE = regex.compile(_ENDINGS + r"|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")


NOTHING = re.compile(r"(?!)")


def cut(text: str, special: re.Pattern) -> list[str]:
    """The words of a text in order, special strings among them."""
    if "<|" in text and special.search(text):
        out = []
        for piece in special.split(text):
            out += [piece] if special.fullmatch(piece) else cut(piece, NOTHING)
        return out
    if text.isascii():
        return _ASCII.findall(text.lower())
    return _UNICODE.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())


def _encode(tables, finish):
    """A function from texts to what ``finish`` makes of the tables and the token lists, block by block of texts.

    Blocks leave as they are made, so neither side of the exchange holds the tokens of a whole batch.
    """

    def encode(texts: pa.Array) -> Iterator[pa.Array]:
        known = tables.value
        special = re.compile("(" + "|".join(map(re.escape, known["specials"])) + ")") if known["specials"] else NOTHING
        low = 0
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        while low < len(texts):
            done = ends[low - 1] if low else 0
            high = max(int(np.searchsorted(ends, done + BLOCK, side="right")), low + 1)
            rows = texts.slice(low, high - low).to_pylist()
            yield finish(known, block(known, [cut(row or "", special) for row in rows]))
            low = high

    def forget() -> dict:
        return {"place": {}, "flat": np.zeros(0, np.int32), "sizes": np.zeros(0, np.int64)}

    state = forget()

    def block(known: dict, cuts: list[list[str]]) -> pa.Array:
        if len(state["place"]) > CACHED_WORDS:
            state.update(forget())
        place = state["place"]
        new = [w for w in dict.fromkeys(chain.from_iterable(cuts)) if w not in place]
        special = known["specials"]
        plain = [w for w in new if w not in special]
        rest = [w for w in new if w in special]
        found = encode_words(known, [w.encode() for w in plain]) + [[special[w]] for w in rest]
        place.update(zip(plain + rest, range(len(place), len(place) + len(new))))
        more = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        tokens_of = np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(more.sum()))
        sizes = state["sizes"] = np.append(state["sizes"], more)
        flat = state["flat"] = np.append(state["flat"], tokens_of)
        starts = np.cumsum(sizes) - sizes
        # One gather for all texts.
        counts = np.fromiter(map(len, cuts), dtype=np.int64, count=len(cuts))
        at = np.fromiter(map(place.__getitem__, chain.from_iterable(cuts)), dtype=np.int64, count=int(counts.sum()))
        own = sizes[at]
        ends = np.cumsum(own)
        tokens = flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[at] - (ends - own), own)]
        edges = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]
        return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(tokens))

    return encode


def _decoded(names: list[str], ids: pa.ListArray) -> pa.Array:
    flat = pa.array(names).take(ids.flatten())
    offsets = np.concatenate(([0], np.cumsum(np.diff(ids.offsets.to_numpy())))).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), flat), " ")


def encoder(spark: SparkSession, path: str):
    """A column function from texts to their lists of token ids."""
    run = _encode(spark.sparkContext.broadcast(load(path)), lambda known, tokens: tokens)

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield from run(texts)

    # Marked so that a plan that uses the tokens more than once does not encode more than once.
    return F.arrow_udf(encode, "array<int>").asNondeterministic()


def coder(spark: SparkSession, path: str):
    """A column function from texts to (tokens, decoded): their token ids and the text of these, by one Python worker a task."""
    kind = pa.struct([("tokens", pa.list_(pa.int32())), ("decoded", pa.string())])

    def finish(known: dict, tokens: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays([tokens, _decoded(known["text"], tokens)], fields=list(kind))

    run = _encode(spark.sparkContext.broadcast(load(path)), finish)

    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield from run(texts)

    return F.arrow_udf(code, "struct<tokens:array<int>,decoded:string>").asNondeterministic()


def decoder(spark: SparkSession, path: str):
    """A column function from lists of token ids to their text."""
    names = spark.sparkContext.broadcast(load(path)["text"])

    def decode(ids: pa.Array) -> pa.Array:
        return _decoded(names.value, ids)

    return F.arrow_udf(decode, "string")
