"""All registered queries."""

from corpusflow.plans import (  # noqa: F401
    queries_corpus,
    queries_rows,
    queries_text,
    queries_tokens,
)
from corpusflow.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
