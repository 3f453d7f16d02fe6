"""Registered queries: a Spark function each, and where SQL can say it, an independent SQL text."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from indicatrix.plans.standins import Tables
from indicatrix.plans.views import VIEWS
from indicatrix.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the tables under a name, with the SQL that must agree with it."""

    def add(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: build(Tables(configure(spark), sf_dir))
        if sql is not None:
            SQL[name] = with_views(sql)
        return build

    return add


def with_views(body: str) -> str:
    """Put the views a text mentions, and the views those mention, in front of it."""
    needed: set[str] = set()
    texts = [body]
    while texts:
        text = texts.pop()
        for name, view in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                texts.append(view)
    heads = [f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in needed]
    if not heads:
        return body
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {', '.join(heads)}, {body[5:]}"
    return f"WITH {', '.join(heads)} {body}"
