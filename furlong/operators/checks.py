"""Table checks. Each returns the failing rows; no rows means the check passes. A report runs all checks of a table in one pass."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values held by more than one row; NULLs do not count."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child values without a parent; NULL children are skipped."""
    children = child.where(F.col(column).isNotNull()).select(F.col(column).alias("from_field"))
    parents = parent.where(F.col(field).isNotNull()).select(F.col(field).alias("to_field"))
    return children.join(parents, F.col("from_field") == F.col("to_field"), "left_anti")


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list, with their row counts; NULLs pass."""
    return (
        df.where(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def expression_is_true(df: DataFrame, expression: str) -> DataFrame:
    """Rows where the expression is false; an unknown result passes."""
    return df.where(~F.expr(expression))


def failures(check: DataFrame, name: str) -> DataFrame:
    """One row with the number of failing rows."""
    return check.agg(F.lit(name).alias("check_name"), F.count(F.lit(1)).alias("failures"))


@dataclass(frozen=True)
class Rule:
    """A declared check of a table: one of the five above by its name, and what it needs."""

    name: str
    kind: str
    column: str | None = None
    values: tuple = ()
    expression: str | None = None
    parent: DataFrame | None = None
    field: str | None = None


# Sixteen characters of a text fit four bits each: the digits with the first six letters, or with these six signs.
_SIGNS = "-.:/ _"


def _pack(value: str) -> list[Column]:
    """A text as (form, packed), no two texts alike: digests, numbers, dates and keys made of them in half their bytes."""
    text = F.col(value)
    hexadecimal, signed = text.rlike(r"\A[0-9a-f]+\z"), text.rlike(rf"\A[0-9{_SIGNS[1:]}-]+\z")
    # An odd number of digits is filled up in front, so the form tells the parity.
    form = F.when(hexadecimal, 1 + F.length(text) % 2).when(signed, 3 + F.length(text) % 2).otherwise(0)
    digits = F.when(hexadecimal, text).when(signed, F.translate(text, _SIGNS, "abcdef"))
    return [form.alias("form"), F.coalesce(F.unhex(digits), text.cast("binary")).alias("packed")]


def _unpack() -> Column:
    """The text again."""
    digits = F.lower(F.hex("packed"))
    digits = F.when(F.col("form").isin(2, 4), digits.substr(F.lit(2), F.length(digits))).otherwise(digits)
    return F.when(F.col("form") == 0, F.col("packed").cast("string")).when(F.col("form") <= 2, digits).otherwise(F.translate(digits, "abcdef", _SIGNS))


def report(df: DataFrame, rules: list[Rule], row_id: str) -> DataFrame:
    """One row per rule: `check_name`, `failures` as the single checks count them, and the least and greatest failing value as text.

    The table is read once. A row gives a (rule, value) pair for each rule that it breaks, or whose outcome depends on
    other rows; pairs are counted in the map tasks, so a value that fills the table travels once a task. Values are the
    checked ones; of rules on a row (not null, expressions) the row's id. Parents are read for their own field only, and
    their values meet the children's in the same count: pairs are shuffled once, packed, and joined with nothing.
    """
    text = lambda c: F.col(c).cast("string")
    entries = []
    for i, r in enumerate(rules):
        fails, value = {
            "not_null": lambda r=r: (F.col(r.column).isNull(), text(row_id)),
            "expression_is_true": lambda r=r: (~F.expr(r.expression), text(row_id)),
            "unique": lambda r=r: (F.col(r.column).isNotNull(), text(r.column)),
            "accepted_values": lambda r=r: (~F.col(r.column).isin(*r.values), text(r.column)),
            "relationships": lambda r=r: (F.col(r.column).isNotNull(), text(r.column)),
        }[r.kind]()
        entries.append(F.when(fails, F.struct(F.lit(i).alias("rule"), value.alias("value"))))
    pairs = df.select(F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull())))
    n, known = F.count(F.lit(1)).alias("n"), F.lit(False)
    parents = [r.parent.where(F.col(r.field).isNotNull()).select(F.lit(i).alias("rule"), text(r.field).alias("value"))
               for i, r in enumerate(rules) if r.kind == "relationships"]
    if parents:
        pairs = reduce(DataFrame.unionByName, [p.withColumn("parent", F.lit(True)) for p in parents], pairs.withColumn("parent", F.lit(False)))
        n, known = F.count_if(~F.col("parent")).alias("n"), F.bool_or("parent")
    packed = pairs.select("rule", *_pack("value"), *pairs.columns[2:])
    counted = packed.groupBy("rule", "form", "packed").agg(n, known.alias("known"))
    of = lambda kind: F.col("rule").isin([i for i, r in enumerate(rules) if r.kind == kind])
    n = (F.when(of("unique"), (F.col("n") > 1).cast("long")).when(of("accepted_values"), F.lit(1).cast("long"))
         .when(of("relationships") & F.col("known"), F.lit(0).cast("long")).otherwise(F.col("n")))
    failing = counted.withColumn("n", n).where("n > 0").select("rule", "n", _unpack().alias("value"))
    found = failing.groupBy("rule").agg(F.sum("n").alias("failures"), F.min("value").alias("first_value"), F.max("value").alias("last_value"))
    names = df.sparkSession.createDataFrame([(i, r.name) for i, r in enumerate(rules)], "rule int, check_name string")
    return names.join(found, "rule", "left").select("check_name", F.coalesce("failures", F.lit(0)).alias("failures"), "first_value", "last_value")
