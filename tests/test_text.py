"""Column functions on literal rows against plain Python."""

import pytest
from pyspark.sql import functions as F

from corpusflow.functions import numbers as nm
from corpusflow.functions import text as tx
from corpusflow.functions.fim import MIDDLE, PREFIX, SUFFIX, fim_transform


def values(spark, texts, column):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    return [r[0] for r in df.orderBy("i").select(column).collect()]


CODE = [
    "    return 1\n\ndef g():\n  pass", "x\n#c\nclass A", "no stop", "", "\nif x", "a<|endoftext|>b<file_sep>",
    "a\n```python", "a\r\nprint(1)", "tail\n@dec",
]


def test_truncate_at_stop(spark):
    def cut(s):
        found = [s.find(x) for x in tx.STOP_STRINGS if x in s]
        return s[:min(found)] if found else s

    assert values(spark, CODE, tx.truncate_at_stop("t")) == [cut(s) for s in CODE]
    assert values(spark, CODE, tx.truncate_at_stop("t", ["(", ".", "\\"])) == [s.split("(")[0] for s in CODE]
    assert values(spark, CODE, tx.truncate_at_stop("t", [])) == CODE


def test_strip(spark):
    texts = [" \t\x0ba b \n", " x　", "", "   ", "\x1cy\x1f"]
    assert values(spark, texts, tx.strip("t")) == [s.strip() for s in texts]


def test_strip_trailing_stop(spark):
    texts = ["done <|endoftext|>", "done\n  <|endoftext|>", "<|endoftext|>", "a<|endoftext|>b", "x!? <s>"]
    stops = ["<|endoftext|>", "<s>", "?", "!"]

    def py(s):
        for stop in stops:
            if s.endswith(stop):
                s = s[: -len(stop)].rstrip()
        return s

    assert values(spark, texts, tx.strip_trailing_stop("t", stops)) == [py(s) for s in texts]


def test_extract_delimited(spark):
    texts = [
        'def f():\n    """ doc """\n', '"""a"""b"""c """', '"""a', 'x """a""" \'\'\'b\'\'\'', "'''one '''",
        "'''a", "none", '""""""', "'''a'''b'''c'''",
    ]
    got = values(spark, texts, tx.extract_delimited("t"))
    assert [tuple(g) for g in got] == [
        ("doc", "ok"), ("c", "ok"), (None, "bad_markers"), ("a", "ok"), ("one", "ok"), (None, "bad_markers"),
        (None, "no_marker"), ("", "ok"), (None, "bad_markers"),
    ]


def test_clean_all(spark):
    prompt = "  def f(x):\n"
    gens = ["def f(x): return x\nprint(1)", "other text of some length\nif", "def f(x):"]
    df = spark.createDataFrame([(prompt, gens)], "p string, g array<string>")
    got = df.select(tx.clean_all("g", "p")).first()[0]
    p = prompt.strip()
    assert got == ["def f(x): return x", p + gens[1][len(p):].split("\nif")[0], p]
    flags = df.select(F.transform("g", lambda g: tx.starts_with_prompt(g, F.col("p")))).first()[0]
    assert flags == [True, False, True]


def test_answer_to_score(spark):
    texts = [" Yes, it is", "YESTERDAY", "no", "Not sure", "none", "n/a", "", "maybe yes"]
    assert values(spark, texts, tx.answer_to_score("t")) == [0, 0, 1, 1, 1, 0.5, 0.5, 0.5]


def test_render_messages(spark):
    rows = [[("system", "s"), ("user", "u1"), ("assistant", "a1"), ("user", "u2")], [("user", "u")]]
    df = spark.createDataFrame([(r,) for r in rows], "m array<struct<role:string,text:string>>").coalesce(1)
    plain = [r[0] for r in df.select(tx.render_messages("m")).collect()]
    assert plain == ["<s>[INST]  u1 [/INST]a1</s> [INST]  u2 [/INST]", "<s>[INST]  u [/INST]"]
    with_preamble = [r[0] for r in df.select(tx.render_messages("m", "P")).collect()]
    assert with_preamble[1] == "<s>[INST] P\n u [/INST]"


def test_fill_template_does_not_fill_twice(spark):
    got = values(spark, ["{sentence} %s $1"], tx.fill_template("C:{context} S:{sentence}", context="t", sentence=F.lit("x")))
    assert got == ["C:{sentence} %s $1 S:x"]


def test_sentences(spark):
    texts = ["One two three four. Short one. Does it have five words?  Yes it really does!", "", "a.b c.d e.f g.h i"]
    assert values(spark, texts, tx.sentences("t")) == [
        ["One two three four.", "Does it have five words?", "Yes it really does!"], [], ["a.b c.d e.f g.h i"],
    ]


def test_numbers(spark):
    one = spark.range(1)

    def value(c):
        return one.select(c).first()[0]

    for x in (0.575, 0.125, 2.675, 1.005, 1.5, 0.0):
        assert value(nm.round_half_even(F.lit(x))) == round(x * 100) / 100
    for n in (0, 999, 4999, 7500, 12500, 17500, 137545):
        assert value(nm.save_interval(F.lit(n))) == max(round(n // 5 / 1000), 1) * 1000
        assert value(nm.warmup_steps(F.lit(n))) == min(1000, n // 10)
    assert value(nm.tier_by_threshold(F.lit(2000), nm.MICRO_BATCH_TIERS, 64)) == 8
    assert value(nm.tier_by_threshold(F.lit(6.9), nm.MICRO_BATCH_TIERS, 64)) == 64
    assert value(nm.tier_by_threshold(F.lit(6.9), nm.MICRO_BATCH_TIERS_NODES, 32)) == 32
    # 4 * 64 * 4 * 2048 tokens per step.
    assert value(nm.tokens_per_step(256, 1, 4, 2048)) == 2_097_152


def test_sheet_identities(spark):
    """Rows of the published parameter sheet."""
    rows = [(6.9, 137545, 1000), (11.4, 83386, 1000), (15.9, 59963, 1000)]
    df = spark.createDataFrame(rows, "p double, iters bigint, warm bigint")
    assert df.where(nm.warmup_steps("iters") != F.col("warm")).count() == 0


@pytest.mark.parametrize("n,c,k", [(20, 3, 1), (20, 0, 5), (20, 20, 5), (20, 17, 5), (4, 2, 5), (5, 1, 5)])
def test_pass_at_k(spark, n, c, k):
    from math import comb

    got = spark.range(1).select(nm.pass_at_k(F.lit(n), F.lit(c), k)).first()[0]
    if n < k:
        assert got is None
    else:
        assert got == pytest.approx(1 - comb(n - c, k) / comb(n, k))


@pytest.mark.parametrize("rate", [0.0, 1e-9, 0.25, 0.333, 0.999999, 1.0, 2.0, -1.0])
def test_digest_below(spark, rate):
    digests = spark.range(3000).select(nm.seeded_digest(1, "id").alias("d")).unionByName(
        spark.createDataFrame([("0" * 32,), ("f" * 32,), ("40000000" + "0" * 24,)], "d string")
    )
    wrong = digests.where(nm.digest_below(F.col("d"), rate) != (nm.unit_interval(F.col("d")) < F.lit(rate)))
    assert wrong.count() == 0


def test_fim_keeps_every_character(spark):
    texts = [f"line {i}<sep><repo>x{i}<sep>été {i} end" for i in range(200)] + ["", "a"]
    df = spark.createDataFrame(list(enumerate(texts)), "i bigint, t string")
    moved = df.select("i", "t", fim_transform("t", "i", 7, 1.0, 0.5, 0.5, "<sep>", "<repo>").alias("m")).collect()
    changed = 0
    for r in moved:
        parts, fragments = r["m"].split("<sep>"), r["t"].split("<sep>")
        assert len(parts) == len(fragments)
        for part, fragment in zip(parts, fragments):
            if PREFIX not in part:
                assert part == fragment
                continue
            assert not fragment.startswith("<repo>")
            changed += 1
            rest = part[len(PREFIX):]
            if rest.startswith(SUFFIX):
                tail, both = rest[len(SUFFIX):].split(MIDDLE)
                assert both + tail == fragment
            else:
                head, rest = rest.split(SUFFIX)
                tail, middle = rest.split(MIDDLE)
                assert head + middle + tail == fragment
    assert 100 < changed < 300
    same = df.select(fim_transform("t", "i", 7, 0.0).alias("m"), "t").where("m <> t")
    assert same.count() == 0


def test_docstrings_that_cannot_be_told_end_a_strict_job(spark):
    good = spark.createDataFrame([('x """ a """ y',), ("'" * 3 + "b" + "'" * 3,), (None,)], "c string")
    assert [r[0] for r in good.select(tx.extract_delimited("c", strict=True)["value"]).collect()] == ["a", "b", None]
    for text in ("none", '"""', '""" a """ b """'):
        bad = spark.createDataFrame([(text,)], "c string")
        with pytest.raises(Exception, match="no docstring"):
            bad.select(tx.extract_delimited("c", strict=True)["value"]).collect()
