"""All queries of the reference's own operators, by name."""

from __future__ import annotations

from corpusforge.plans import base, function_queries, io_queries, more_queries, relation_queries, study_queries, text_queries
from corpusforge.plans.base import Query

FLAGSHIP = "surviving_sentences"
MODULES = (text_queries, relation_queries, more_queries, io_queries, function_queries, study_queries)


def queries() -> dict[str, Query]:
    return dict(base.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(base.ORACLES)
