"""Context-tree weighting of bytes, each taken as eight binary decisions.

A gram is a number: the ``depth`` bytes before a byte, the nearest first, then the byte itself. The node of a
decision is (context of k bytes, bits of the byte so far); it estimates the next bit from its counts of
zeros and ones as Krichevsky and Trofimov do, and its weighted probability is the mean of its own estimate
and the product of those of the contexts one byte longer. All of it is numpy over sorted grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from corpusflow.llm.blocks import lowered
from corpusflow.llm.common import flat_bytes

#: No UTF-8 text holds it: before every text, and as the symbol of its end.
EDGE = 0xFF
#: Places of text whose grams are made together.
WINDOW = 1 << 19
#: Fractions of a sum of logarithms, so that sums do not depend on their order.
UNIT = 1 << 16


class Level(NamedTuple):
    """Nodes of the contexts of one length, by decision 0 to 7."""

    codes: np.ndarray
    node: list[np.ndarray]  # of each code
    first: list[np.ndarray]  # code of each node
    zeros: list[np.ndarray]
    ones: list[np.ndarray]
    weighted: list[np.ndarray]  # logarithms
    ratio: list[np.ndarray]  # of the own estimate over the longer contexts, logarithms
    up: np.ndarray | None  # place of each code of the level below in this one


def windows(texts: pa.Array, depth: int) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """(grams, place of the first, edges): grams of all texts, text ``i`` having places ``edges[i]:edges[i + 1]``."""
    data, offsets = flat_bytes(texts)
    rows = len(offsets) - 1
    starts = offsets[:-1] + np.arange(rows) * (depth + 1) + depth
    padded = np.full(len(data) + rows * (depth + 1), EDGE, dtype=np.uint8)
    real = np.ones(len(padded), dtype=bool)
    real[(starts[:, None] - np.arange(1, depth + 1)).ravel()] = False
    held = real.copy()
    held[starts + np.diff(offsets)] = False
    padded[held] = lowered(data)
    edges, place = offsets + np.arange(rows + 1), 0
    for low in range(depth, len(padded), WINDOW):
        x = padded[low - depth: low + WINDOW].astype(np.uint64)
        code = x[depth:].copy()
        for j in range(1, depth + 1):
            code |= x[depth - j: len(x) - j] << np.uint64(8 * (depth + 1 - j))
        code = code[real[low: low + WINDOW]]
        yield code, place, edges
        place += len(code)


def distinct(codes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct grams and how often each occurs."""
    if counts is None:
        codes = np.sort(codes)
        starts = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.zeros(0, np.int64)
        return codes[starts], np.diff(np.append(starts, len(codes)))
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    starts = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.zeros(0, np.int64)
    return codes[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """For x from 0.5 on: Stirling's series eight steps up."""
    y, below = x + 8, np.ones(len(x))
    small = np.flatnonzero(x < 64)
    low = x[small]
    product = low.copy()
    for i in range(1, 8):
        product *= low + i
    below[small] = product
    y = np.where(x < 64, y, x)
    return (y - 0.5) * np.log(y) - y + 0.918938533204672742 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(below)


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the probability that the estimator gives a sequence with so many zeros and ones."""
    out = np.zeros(len(zeros))
    seen = np.flatnonzero(zeros + ones)
    a, b = zeros[seen].astype(np.float64), ones[seen].astype(np.float64)
    out[seen] = _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1) - np.log(np.pi)
    return out


def weigh(own: np.ndarray, longer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weighted, ratio) of estimates and of the products of longer contexts, all logarithms."""
    return np.logaddexp(own, longer) - np.log(2), own - longer


def levels(codes: np.ndarray, counts: np.ndarray, depth: int, low: int) -> list[Level]:
    """The contexts of ``depth`` bytes down to ``low``, from sorted distinct grams that hold all grams of their
    contexts of ``low`` bytes."""
    out: list[Level] = []
    for k in range(depth, low - 1, -1):
        up = None
        if k < depth:
            below = out[-1]
            codes, up = np.unique((below.codes >> np.uint64(16) << np.uint64(8)) | (below.codes & np.uint64(255)), return_inverse=True)
            counts = np.bincount(up, weights=counts, minlength=len(codes)).astype(np.int64)
        level = Level(codes, [], [], [], [], [], [], up)
        for j in range(8):
            key = codes >> np.uint64(8 - j)
            new = np.append(True, key[1:] != key[:-1])
            first = np.flatnonzero(new)
            node = np.cumsum(new) - 1
            total = np.add.reduceat(counts, first)
            one = np.add.reduceat(counts * ((codes >> np.uint64(7 - j)) & np.uint64(1)).astype(np.int64), first)
            own = log_estimate(total - one, one)
            if k == depth:
                weighted, ratio = own, np.zeros(0)
            else:
                above = node[up[below.first[j]]]
                weighted, ratio = weigh(own, np.bincount(above, weights=below.weighted[j], minlength=len(first)))
            for column, value in zip(level[1:7], (node, first, total - one, one, weighted, ratio)):
                column.append(value)
        out.append(level)
    return out


def parts_above(level: Level) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(node, zeros, ones, sum of logarithms in UNITs) of the contexts one byte shorter than those of ``level``."""
    keys = []
    for j in range(8):
        code = level.codes[level.first[j]]
        keys.append(((code >> np.uint64(16)) << np.uint64(8)) | np.uint64(1 << j) | ((code & np.uint64(255)) >> np.uint64(8 - j)))
    flat = np.concatenate(keys)
    logs = np.rint(np.concatenate(level.weighted) * UNIT).astype(np.int64)
    order = np.argsort(flat, kind="stable")
    flat = flat[order]
    starts = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
    sums = [np.add.reduceat(v[order], starts) for v in (np.concatenate(level.zeros), np.concatenate(level.ones), logs)]
    return flat[starts].astype(np.int64), *sums


class Top(NamedTuple):
    """Nodes of the shortest contexts by (context, bits so far), sorted: bounded by the number of such contexts."""

    key: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    ratio: np.ndarray


def tops(key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, longer: np.ndarray, low: int) -> list[Top]:
    """The contexts of ``low - 1`` bytes down to none, from the nodes of the former in order."""
    out = []
    for k in range(low - 1, -1, -1):
        weighted, ratio = weigh(log_estimate(zeros, ones), longer)
        out.append(Top(key, zeros, ones, ratio))
        if k:
            short = (key >> 16 << 8) | (key & 255)
            key, up = np.unique(short, return_inverse=True)
            zeros, ones = (np.bincount(up, weights=v, minlength=len(key)).astype(np.int64) for v in (zeros, ones))
            longer = np.bincount(up, weights=weighted, minlength=len(key))
    return out


def _estimate(zeros: np.ndarray, ones: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return (np.where(bit, ones, zeros) + 0.5) / (zeros + ones + 1.0)


def _share(ratio: np.ndarray) -> np.ndarray:
    """Weight of a node's own estimate against the longer contexts."""
    return 1 / (1 + np.exp(np.clip(-ratio, -700, 700)))


def log10_of(found: list[Level], top: list[Top]) -> np.ndarray:
    """log10 of the probability of each gram's byte in its context, all lengths of context mixed."""
    deepest = found[0]
    total = np.zeros(len(deepest.codes))
    for j in range(8):
        bit = ((deepest.codes >> np.uint64(7 - j)) & np.uint64(1)).astype(bool)
        p, at = None, np.arange(len(deepest.codes))
        for level in found:
            if level.up is not None:
                at = level.up[at]
            node = level.node[j][at]
            own = _estimate(level.zeros[j][node], level.ones[j][node], bit)
            if p is None:
                p = own
            else:
                share = _share(level.ratio[j][node])
                p = share * own + (1 - share) * p
        context, byte = deepest.codes >> np.uint64(8), deepest.codes & np.uint64(255)
        short = np.uint64(1 << j) | (byte >> np.uint64(8 - j))
        length = len(found) + len(top) - 1
        for i, level in enumerate(top):
            k = len(top) - 1 - i
            key = ((context >> np.uint64(8 * (length - k)) if k else context * np.uint64(0)) << np.uint64(8)) | short
            node = np.searchsorted(level.key, key.astype(np.int64))
            share = _share(level.ratio[node])
            p = share * _estimate(level.zeros[node], level.ones[node], bit) + (1 - share) * p
        total += np.log10(p)
    return total
