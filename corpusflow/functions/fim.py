"""Fill-in-the-middle: cut text into prefix, middle and suffix and reorder."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow.functions.numbers import ColumnOrName, as_column, digest_below, seeded_digest, unit_interval
from corpusflow.functions.text import let

PREFIX, MIDDLE, SUFFIX = "<fim_prefix>", "<fim_middle>", "<fim_suffix>"


def _draw(seed, name: str, *ids) -> Column:
    return unit_interval(seeded_digest(f"{seed}:{name}", *ids))


def _chance(rate: float, seed, name: str, *ids) -> Column:
    return digest_below(seeded_digest(f"{seed}:{name}", *ids), rate)


def _reorder(fragment: Column, u: Column, v: Column, spm: Column) -> Column:
    """Cut at the two (sorted) positions drawn as shares of the length."""

    def cut(points: Column) -> Column:
        lo, hi = F.array_min(points), F.array_max(points)
        head = F.substr(fragment, F.lit(1), lo)
        middle = F.substr(fragment, lo + 1, hi - lo)
        tail = F.substr(fragment, hi + 1)
        psm = F.concat(F.lit(PREFIX), head, F.lit(SUFFIX), tail, F.lit(MIDDLE), middle)
        swapped = F.concat(F.lit(PREFIX + SUFFIX), tail, F.lit(MIDDLE), head, middle)
        return F.when(spm, swapped).otherwise(psm)

    length = F.length(fragment)

    def point(share: Column) -> Column:
        return F.floor(share * (length + 1)).cast("int")

    return let(F.array(point(u), point(v)), cut)


def fim_transform(
    text: ColumnOrName,
    doc_id: ColumnOrName,
    seed: int | str,
    rate: float = 0.5,
    spm_rate: float = 0.5,
    fragment_rate: float = 0.5,
    separator: str | None = None,
    no_fim_prefix: str | None = None,
) -> Column:
    """The text with a share of documents (and of their fragments) reordered.

    One draw per document decides against ``rate``. A text with ``separator`` is cut into
    fragments, each with a draw of its own against ``fragment_rate``; fragments that start with
    ``no_fim_prefix`` stay as they are. All draws are digests of seed, document and fragment.
    """
    text, doc_id = as_column(text), as_column(doc_id)

    def one(fragment: Column, index: Column, several: Column) -> Column:
        chosen = ~several | _chance(fragment_rate, seed, "fragment", doc_id, index)
        if no_fim_prefix:
            chosen = chosen & ~F.startswith(fragment, F.lit(no_fim_prefix))
        reordered = _reorder(
            fragment,
            _draw(seed, "u", doc_id, index),
            _draw(seed, "v", doc_id, index),
            _chance(spm_rate, seed, "spm", doc_id, index),
        )
        return F.when(chosen, reordered).otherwise(fragment)

    if separator:
        quoted = "\\Q" + separator + "\\E"
        whole = let(
            F.split(text, quoted, -1),
            lambda parts: F.array_join(
                F.transform(parts, lambda p, i: one(p, i, F.size(parts) > 1)), separator
            ),
        )
    else:
        whole = one(text, F.lit(0), F.lit(False))
    return F.when(_chance(rate, seed, "document", doc_id), whole).otherwise(text)
