"""Queries over the driver's tables, each with the SQL that must give the same rows.

A query declares its output columns with a type letter, from which both sides get the same
plain result types::

    l bigint   f double   m money (as exact text)   b boolean   s text   d date (as text)
    t timestamp (as text)
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furlong.functions.money import MONEY
from furlong.registry import proxies
from furlong.session import METHOD_LIMIT, SETTINGS


@dataclass
class Inputs:
    """What a query may read: tables by name, and a scratch folder for those that store something."""

    spark: SparkSession
    sf_dir: str

    def __call__(self, name: str) -> DataFrame:
        return proxies.table(self.spark, self.sf_dir, name)

    def scratch(self) -> str:
        """A new folder under the session's shared checkpoint folder, or its warehouse where none is set."""
        base = self.spark.conf.get("spark.checkpoint.dir", None) or self.spark.conf.get("spark.sql.warehouse.dir")
        return f"{base.rstrip('/')}/furlong-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Query:
    columns: dict[str, str]
    run: Callable[[Inputs], DataFrame]
    sql: str | None

    def dataframe(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        # Timestamps are UTC instants on both sides of the comparison.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.set(METHOD_LIMIT, SETTINGS[METHOD_LIMIT])
        df = self.run(Inputs(spark, sf_dir))
        return df.select(*[_spark_cast(F.col(c), t).alias(c) for c, t in self.columns.items()])


def _spark_cast(col: Column, letter: str) -> Column:
    if letter == "t":
        return F.date_format(col, "yyyy-MM-dd HH:mm:ss")
    if letter == "m":
        return col.cast(MONEY).cast("string")
    return col.cast({"l": "bigint", "f": "double", "b": "boolean", "s": "string"}.get(letter, "date")).cast(
        "string" if letter == "d" else _SPARK[letter]
    )


_SPARK = {"l": "bigint", "f": "double", "b": "boolean", "s": "string"}


def _sql_cast(name: str, letter: str) -> str:
    if letter == "t":
        return f"strftime({name}, '%Y-%m-%d %H:%M:%S') AS {name}"
    if letter == "d":
        return f"CAST(CAST({name} AS DATE) AS VARCHAR) AS {name}"
    if letter == "m":
        return f"CAST(CAST({name} AS DECIMAL(16,2)) AS VARCHAR) AS {name}"
    dtype = {"l": "BIGINT", "f": "DOUBLE", "b": "BOOLEAN", "s": "VARCHAR"}[letter]
    return f"CAST({name} AS {dtype}) AS {name}"


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.models: dict[str, str] = {}

    def model(self, name: str, sql: str) -> None:
        """SQL of an intermediate relation that oracle texts may name."""
        self.models[name] = sql

    def add(self, name: str, columns: str, run: Callable[[Inputs], DataFrame], sql: str | None) -> None:
        if name in self.queries:
            raise ValueError(f"duplicate query {name}")
        spec = dict(c.split(":") if ":" in c else (c, "s") for c in columns.split())
        self.queries[name] = Query(spec, run, sql)

    def oracle(self, name: str) -> str | None:
        """The comparison SQL, self-contained on the driver's tables."""
        query = self.queries[name]
        if query.sql is None:
            return None
        order: list[str] = []
        self._visit(query.sql, order)
        parts = [f"{r} AS ({self._text(r)})" for r in order]
        outer = ", ".join(_sql_cast(c, t) for c, t in query.columns.items())
        parts.append(f"answer AS ({query.sql})")
        return f"WITH {', '.join(parts)} SELECT {outer} FROM answer"

    def _text(self, relation: str) -> str:
        return self.models[relation] if relation in self.models else proxies.proxy_sql(relation)

    def _visit(self, sql: str, order: list[str]) -> None:
        names = set(re.findall(r"\b[a-z_]+\b", sql))
        for relation in [*proxies.PROXIES, *self.models]:
            if relation in names and relation not in order:
                self._visit_relation(relation, order)

    def _visit_relation(self, relation: str, order: list[str]) -> None:
        if relation in order:
            return
        if relation in self.models:
            self._visit_names(self.models[relation], relation, order)
        else:
            for parent in proxies.needed([relation]):
                if parent not in order:
                    order.append(parent)
            return
        order.append(relation)

    def _visit_names(self, sql: str, itself: str, order: list[str]) -> None:
        names = set(re.findall(r"\b[a-z_]+\b", sql)) - {itself}
        for relation in [*proxies.PROXIES, *self.models]:
            if relation in names and relation not in order:
                self._visit_relation(relation, order)


registry = Registry()
