"""Text functions on columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow.functions.numbers import ColumnOrName, as_column

# The characters that count as white space at the edge of a string.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Strings that end a generated code solution.
STOP_STRINGS = [
    "\nclass", "\ndef", "\n#", "\n@", "\nprint", "\nif", "\n```",
    "<filename>", "<file_sep>", "<|endoftext|>",
]

# Solutions too generic to count as benchmark text.
GENERIC_SOLUTIONS = ["return x + y", "return len(string)", "return n**2", "return ''.join(strings)"]

# Question put to a judge model about one sentence.
SUPPORT_TEMPLATE = (
    "Context: {context}\n\nSentence: {sentence}\n\n"
    "Is the sentence supported by the context above? Answer Yes or No.\n\nAnswer: "
)
# The same question with reasoning asked for.
SUPPORT_TEMPLATE_STEPS = (
    "Context: {context}\n\nSentence: {sentence}\n\n"
    "Is the sentence supported by the context above? "
    "Think step by step and put your answer of Yes or No first.\n\nAnswer: "
)

NOT_WORD = r"[^\p{L}\p{N}_]+"
SENTENCE_BREAK = r"(?<=[.!?])\s+"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``.

    A column captured by a lambda is evaluated again for every element, so an expensive array must
    become a lambda variable itself.
    """
    return F.transform(F.array(value), body)[0]


def strip(c: ColumnOrName) -> Column:
    """Remove white space of any kind at both ends (``trim`` alone removes blanks only)."""
    return F.btrim(as_column(c), F.lit(WHITESPACE))


def strip_end(c: ColumnOrName) -> Column:
    return F.rtrim(as_column(c), F.lit(WHITESPACE))


def words(c: ColumnOrName) -> Column:
    """Lower-cased runs of letters, digits and underscores."""
    # Splitting costs half of what extracting does; it leaves an empty string at an edge.
    return F.array_remove(F.split(F.lower(as_column(c)), NOT_WORD, -1), "")


def normalize_newlines(c: ColumnOrName) -> Column:
    return F.translate(as_column(c), "\n", " ")


def leading_number(c: ColumnOrName) -> Column:
    """The digits a name starts with, as a long; null where it starts with none."""
    return F.regexp_extract(as_column(c), r"^(\d+)", 1).try_cast("long")


def number_in(c: ColumnOrName) -> Column:
    """The first run of digits in a name, as a long; null where there is none."""
    return F.regexp_extract(as_column(c), r"(\d+)", 1).try_cast("long")


def extract_delimited(c: ColumnOrName, strict: bool = False) -> Column:
    """Docstring of a prompt as ``struct(value, status)``.

    Text between the only pair of triple double quotes, or between the second of two pairs;
    without any, text between the only pair of triple single quotes. Any other count of markers
    gives a null value and the status ``bad_markers``; no marker at all gives ``no_marker``.
    With ``strict`` either ends the job; a null text stays null.
    """
    c = as_column(c)

    def pick(double: Column) -> Column:
        single = F.split(c, "'''", -1)
        n_double = F.size(double) - 1
        n_single = F.size(single) - 1
        value = (
            F.when(n_double == 2, F.get(double, F.lit(1)))
            .when(n_double == 4, F.get(double, F.lit(3)))
            .when((n_double == 0) & (n_single == 2), F.get(single, F.lit(1)))
        )
        status = (
            F.when(value.isNotNull(), F.lit("ok"))
            .when((n_double == 0) & (n_single == 0), F.lit("no_marker"))
            .otherwise(F.lit("bad_markers"))
        )
        if strict:
            # A null text has no markers to count.
            problem = F.raise_error(F.concat(F.lit("no docstring can be told: "), status)).cast("string")
            value = F.when(value.isNotNull() | n_double.isNull() | (n_double < 0), value).otherwise(problem)
        return F.struct(strip(value).alias("value"), status.alias("status"))

    return let(F.split(c, '"""', -1), pick)


def truncate_at_stop(c: ColumnOrName, stops: Sequence[str] = STOP_STRINGS) -> Column:
    """The text before the earliest stop string."""
    c = as_column(c)
    stops = [s for s in stops if s]
    if not stops:
        return c
    pattern = "|".join(re.escape(s) for s in stops)
    return F.split(c, pattern, 2)[0]


def strip_trailing_stop(c: ColumnOrName, stops: Sequence[str] = ("<|endoftext|>",)) -> Column:
    """Take a stop string and the white space before it off the end, one stop after the other."""
    c = as_column(c)

    def without(x: Column, stop: str) -> Column:
        rest = F.substr(x, F.lit(1), F.length(x) - F.lit(len(stop)))
        return F.when(F.endswith(x, F.lit(stop)), strip_end(rest)).otherwise(x)

    for stop in filter(None, stops):
        c = let(c, lambda x: without(x, stop))
    return c


def clean_generation(
    generation: ColumnOrName, prompt: ColumnOrName, stops: Sequence[str] = STOP_STRINGS
) -> Column:
    """The stripped prompt followed by the generated part up to the first stop string.

    As many characters as the stripped prompt has are cut off the front, also where they are not
    the prompt; ``starts_with_prompt`` reports those.
    """
    prompt = strip(prompt)
    rest = F.substr(as_column(generation), F.length(prompt) + F.lit(1))
    return F.concat(prompt, truncate_at_stop(rest, stops))


def starts_with_prompt(generation: ColumnOrName, prompt: ColumnOrName, chars: int = 20) -> Column:
    return F.startswith(as_column(generation), F.substr(strip(prompt), F.lit(1), F.lit(chars)))


def clean_all(
    generations: ColumnOrName, prompt: ColumnOrName, stops: Sequence[str] = STOP_STRINGS
) -> Column:
    """``clean_generation`` over an array of generations, order kept."""
    return let(
        as_column(prompt),
        lambda p: F.transform(as_column(generations), lambda g: clean_generation(g, p, stops)),
    )


def fill_template(template: str, **values: ColumnOrName) -> Column:
    """A template with ``{name}`` places filled from columns; filled text is not searched again."""
    parts = re.split(r"\{(\w+)\}", template)
    pieces = []
    for i, part in enumerate(parts):
        if i % 2:
            pieces.append(as_column(values[part]))
        elif part:
            pieces.append(F.lit(part))
    return F.concat(*pieces)


def answer_to_score(c: ColumnOrName) -> Column:
    """A judge's answer as a number: yes 0, no 1, anything else 0.5."""
    answer = strip(F.lower(as_column(c)))
    return (
        F.when(F.startswith(answer, F.lit("yes")), F.lit(0.0))
        .when(F.startswith(answer, F.lit("no")), F.lit(1.0))
        .otherwise(F.lit(0.5))
    )


def turn_piece(
    role: ColumnOrName, text: ColumnOrName, is_first: Column, preamble: str | None = None
) -> Column:
    """One chat turn as text; turns of other roles than user and assistant give nothing."""
    role, text = as_column(role), as_column(text)
    opening = F.when(is_first, F.lit(f"{preamble}\n")).otherwise(F.lit("")) if preamble else F.lit("")
    return (
        F.when(role == "user", F.concat(F.lit("[INST] "), opening, F.lit(" "), text, F.lit(" [/INST]")))
        .when(role == "assistant", F.concat(text, F.lit("</s> ")))
        .otherwise(F.lit(""))
    )


def render_messages(messages: ColumnOrName, preamble: str | None = None) -> Column:
    """An array of ``struct(role, text)`` as one prompt string."""
    pieces = F.transform(
        as_column(messages),
        lambda m, i: turn_piece(m["role"], m["text"], i == 0, preamble),
    )
    return F.concat(F.lit("<s>"), F.array_join(pieces, ""))


def sentences(c: ColumnOrName, more_than: int = 3) -> Column:
    """Stripped sentences with more than ``more_than`` words, by end marks followed by space."""
    parts = F.transform(F.split(as_column(c), SENTENCE_BREAK, -1), strip)
    return F.filter(parts, lambda s: F.size(F.split(s, r"\s+")) > more_than)
