"""Language identification by error-correcting output codes.

Every language has a codeword; one binary classifier per bit, over hashed byte n-grams, predicts that
bit of a text's codeword. Decoding weighs each bit's loss by its margin and takes the codeword of the least
loss; where the second best is nearly as good, the text is flagged as ambiguous.

The classifiers are fitted on n-gram counts of all labelled texts, per language; the driver holds
languages x BUCKETS counts. A prediction reads the text alone.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every text when no
labelled text was given. One language only is predicted with score 1. Ties go to the language that comes
first by name. Rows with a null label are not learned from. Repeated rows count each. Columns beside those
named are not read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import common

UND = "und"
SIZES = (2, 3, 4)
#: Hashed n-grams per size.
BUCKETS = 1 << 14
#: Bytes of texts handled together.
BLOCK = 1 << 18
#: A gap between the best losses below this is ambiguous.
GAP = 1.0
EXHAUSTIVE = 7


def _blocks(texts: pa.Array):
    """(first row, row after the last, where each text begins, bytes) of runs of texts; empty ones have no bytes."""
    data, offsets = common.flat_bytes(texts)
    low = 0
    while low < len(texts):
        high = max(int(np.searchsorted(offsets, offsets[low] + BLOCK, side="right")) - 1, low + 1)
        high = min(high, len(texts))
        yield low, high, offsets[low: high + 1] - offsets[low], data[offsets[low]: offsets[high]]
        low = high


def _grams(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, validity) of the n-gram at every byte; none goes over the end of its text."""
    letter = (((data | np.uint8(0x20)) - np.uint8(97)) < 26) | (data >= 128)
    plain = np.where(letter, np.where(data < 128, data | np.uint8(0x20), data), np.uint8(0x20)).astype(np.uint32)
    total = plain.copy()
    for j in range(1, size):
        total *= np.uint32(0x01000193)
        total[:-j] += plain[j:]
    total ^= total >> np.uint32(15)
    total *= np.uint32(0x2C1B3C6D)
    valid = np.ones(len(data), dtype=bool)
    ends = offsets[1:]
    for j in range(1, size):
        before = ends - j
        valid[before[before >= offsets[:-1]]] = False
    return (total >> np.uint32(32 - 14)).astype(np.int32), valid


def gram_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, n): n-grams of all texts by language, counted where they are read."""
    width = BUCKETS * len(SIZES)

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(1).to_pylist()
            for low, high, offsets, data in _blocks(batch.column(0)):
                if not len(data):
                    continue
                found = sorted(set(names[low:high]))
                number = {name: i for i, name in enumerate(found)}
                owner = np.repeat([number[n] for n in names[low:high]], np.diff(offsets))
                for s, size in enumerate(SIZES):
                    bucket, valid = _grams(data, offsets, size)
                    sums = np.bincount((owner * BUCKETS + bucket)[valid], minlength=len(found) * BUCKETS)
                    for name, i in number.items():
                        total = totals.setdefault(name, np.zeros(width, dtype=np.int64))
                        total[s * BUCKETS: (s + 1) * BUCKETS] += sums[i * BUCKETS: (i + 1) * BUCKETS]
        for name, total in totals.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used)), pa.array(used.astype(np.int32)), pa.array(total[used])], ["lang", "gram", "n"]
            )

    read = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(text, F.col(lang).alias("lang"))
    return read.mapInArrow(count, "lang string, gram int, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def codewords(k: int) -> np.ndarray:
    """(k, bits) of +1 and -1: all splits of few languages, distinct random splits of many."""
    if k <= EXHAUSTIVE:
        rest = itertools.product((1, -1), repeat=max(k - 1, 0))
        columns = [(1, *r) for r in rest if -1 in r]
    else:
        draw, columns = np.random.default_rng(5), []
        seen = set()
        while len(columns) < 15 * int(np.ceil(np.log2(k))):
            column = tuple(draw.choice((1, -1), k))
            if abs(sum(column)) < k and column not in seen:
                seen |= {column, tuple(-c for c in column)}
                columns.append(column)
    return np.array(columns, dtype=np.float64).reshape(len(columns), k).T


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict:
    """Languages, their codewords, and the weight of every n-gram for every bit."""
    with common.short_batches(docs.sparkSession):
        found = gram_counts(docs, text, lang).toArrow()
    names = sorted(set(found["lang"].to_pylist()))
    place = {name: i for i, name in enumerate(names)}
    counts = np.zeros((len(names), BUCKETS * len(SIZES)))
    counts[[place[n] for n in found["lang"].to_pylist()], found["gram"].to_numpy()] = found["n"].to_numpy()
    code = codewords(len(names))
    weights = np.zeros((BUCKETS * len(SIZES), code.shape[1]), dtype=np.float32)
    for s in range(len(SIZES)):
        part = slice(s * BUCKETS, (s + 1) * BUCKETS)
        own = counts[:, part] + 0.5
        share = own / own.sum(axis=1, keepdims=True)
        for bit in range(code.shape[1]):
            # Languages weigh the same on their side of a split, however many texts they have.
            one, other = share[code[:, bit] > 0].mean(axis=0), share[code[:, bit] < 0].mean(axis=0)
            weights[part, bit] = np.log(one) - np.log(other)
    return {"languages": names, "code": code, "weights": weights}


def _predictor(model):
    kind = "struct<lang:string,score:double,ambiguous:boolean>"

    def of(texts: pa.Array) -> pa.Array:
        names, code, weights = (model.value[k] for k in ("languages", "code", "weights"))
        best = np.zeros(len(texts), dtype=np.int64)
        score = np.zeros(len(texts))
        unclear = np.zeros(len(texts), dtype=bool)
        for low, high, offsets, data in _blocks(texts):
            sums = np.zeros((high - low, code.shape[1]))
            filled = np.flatnonzero(np.diff(offsets))
            grams = np.zeros(high - low)
            if len(filled) and code.shape[1]:
                for s, size in enumerate(SIZES):
                    bucket, valid = _grams(data, offsets, size)
                    for first in range(0, len(data), 1 << 16):  # weights of a few bytes at a time
                        piece = slice(first, first + (1 << 16))
                        margin = weights[s * BUCKETS + bucket[piece]]
                        margin[~valid[piece]] = 0
                        inside = offsets[filled]
                        rows = filled[(inside < first + len(margin)) & (offsets[filled + 1] > first)]
                        starts = np.maximum(offsets[rows] - first, 0)
                        sums[rows] += np.add.reduceat(margin, starts, axis=0)
                grams[filled] = np.diff(offsets)[filled] * len(SIZES)
            # Margins grow with the root of the evidence; the loss of a bit is logistic.
            z = sums / np.sqrt(np.maximum(grams, 1))[:, None]
            loss = np.logaddexp(0, -z[:, None, :] * code[None]).sum(axis=2) if len(names) else np.zeros((high - low, 1))
            at = loss.argmin(axis=1)
            least = loss.min(axis=1)
            best[low:high] = at
            score[low:high] = 1 / np.exp(least[:, None] - loss).sum(axis=1)
            if loss.shape[1] > 1:
                unclear[low:high] = np.partition(loss, 1, axis=1)[:, 1] - least < GAP
        labels = pa.array(names or [UND]).take(pa.array(best))
        return pa.StructArray.from_arrays([labels, pa.array(score), pa.array(unclear)], ["lang", "score", "ambiguous"])

    return F.arrow_udf(of, kind)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: dict, text: str = "text") -> Column:
    """(lang, score, ambiguous) as one column."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    none = F.struct(F.lit(UND).alias("lang"), F.lit(0.0).alias("score"), F.lit(True).alias("ambiguous"))
    if not model["languages"]:
        return none
    return F.when(has_letter(F.col(text)), _predictor(sent)(F.col(text))).otherwise(none)


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether a document is kept from fitting: by a checksum of its id; a null id is learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == F.lit(fold), F.lit(False))
