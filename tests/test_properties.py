"""Text functions against Python on generated strings, all in one job per example."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusflow.functions import text as tx

SETTINGS = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow]
)
alphabet = st.sampled_from(list("ab.Z! \n\t\x0b#'\"()\\$^|") + ["é", "ß", " ", "漢", "\U0001f600", "\nif", "stop", '"""', "'''"])
texts = st.lists(st.lists(alphabet, max_size=25).map("".join), min_size=30, max_size=60)


def run(spark, values, column):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string").coalesce(1)
    return [r[0] for r in df.select("i", column).orderBy("i").select(F.col(df.select(column).columns[0])).collect()]


@SETTINGS
@given(values=texts)
def test_stops(spark, values):
    stops = ["stop", "\nif", ".", "(a", "\\", "$^"]

    def cut(s):
        return s[: min([len(s)] + [s.find(x) for x in stops if x in s])]

    def trail(s):
        for stop in stops:
            if s.endswith(stop):
                s = s[: -len(stop)].rstrip()
        return s

    assert run(spark, values, tx.truncate_at_stop("t", stops).alias("x")) == [cut(s) for s in values]
    assert run(spark, values, tx.strip_trailing_stop("t", stops).alias("x")) == [trail(s) for s in values]


@SETTINGS
@given(values=texts)
def test_strip_and_words(spark, values):
    assert run(spark, values, tx.strip("t").alias("x")) == [s.strip() for s in values]
    assert run(spark, values, tx.words("t").alias("x")) == [re.findall(r"\w+", s.lower()) for s in values]


@SETTINGS
@given(values=texts)
def test_docstrings(spark, values):
    def extract(s):
        if '"""' in s:
            parts = s.split('"""')
            return parts[1].strip() if len(parts) == 3 else parts[3].strip() if len(parts) == 5 else None
        parts = s.split("'''")
        return parts[1].strip() if len(parts) == 3 else None

    assert run(spark, values, tx.extract_delimited("t")["value"].alias("x")) == [extract(s) for s in values]
