"""The type gate: does a JSON record fit a declared schema?

Every field may be missing or null. A field of the wrong type rejects the whole record;
unknown fields are dropped. The rules follow lax validation of declared types:

    string           a JSON string only
    double           number, numeric text, true/false
    int / bigint     whole number, whole-number text, true/false
    boolean          true/false, 0/1, and the usual words for them
    array<variant>   an array whose every element is an object

``from_json`` is looser in places (5 under a string becomes "5") and stricter in others
("12.5" under a double is corrupt), so the gate looks at the JSON types themselves, through
VARIANT. Everything is a built-in expression over one row: no shuffle, no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furlong.functions.parsing import BLANKS, FLOAT_PATTERN, INTEGRAL_PATTERN, ZERO_FRACTION
from furlong.operators.stage import compute_once

# Texts that count as booleans, in any letter case.
TRUE_WORDS = ("1", "on", "t", "true", "y", "yes")
FALSE_WORDS = ("0", "off", "f", "false", "n", "no")

RECORD = "record"
OK = "gate_ok"
ERRORS = "gate_errors"
UNREADABLE = "record"
OBJECT_LIST = "OBJECTS"


_SCALAR_KINDS = "('VOID', 'BIGINT', 'DOUBLE', 'FLOAT', 'BOOLEAN')"


def _quoted(words: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def is_object(value: str) -> str:
    """Is the value a JSON object? Read as a struct, it is one or it is nothing; its fields are not visited."""
    return f"try_variant_get({value}, '$', 'struct<_any variant>') IS NOT NULL"


class _Field:
    """One declared field, as SQL expressions.

    ``fits`` and ``typed`` read the columns that ``look_ups`` stored: the JSON kind ``_k_``, the value as text ``_t_``
    and the value itself ``_v_``. Reading a VARIANT as a plain type costs as much as parsing it, so each value is read
    once, as text, and the usual kinds are converted from that; the others go by the value. ``typed`` is right for
    values that fit; the others never leave the gate.
    """

    def __init__(self, name: str, path: str, dtype: T.DataType):
        self.name, self.path, self.dtype = name, path, dtype
        # A missing field has no kind, a null one is VOID; both pass.
        self.kind = f"coalesce(`_k_{name}`, 'VOID')"
        self.value = f"`_v_{name}`"
        self.text = f"`_t_{name}`"
        self.number = f"try_variant_get({self.value}, '$', 'double')"
        self.scalar = f"({self.kind} IN {_SCALAR_KINDS} OR startswith({self.kind}, 'DECIMAL'))"

    def look_ups(self, value: str, text: str) -> dict[str, str]:
        """Stored columns, of the expressions for the value and for its text."""
        if isinstance(self.dtype, T.ArrayType):
            items = f"try_variant_get({value}, '$', 'array<variant>')"
            kind = (f"CASE WHEN {value} IS NULL OR is_variant_null({value}) THEN 'VOID' "
                    f"WHEN forall({items}, e -> {is_object('e')}) THEN '{OBJECT_LIST}' ELSE 'OTHER' END")
            return {f"_k_{self.name}": kind, f"_v_{self.name}": items}
        found = {f"_k_{self.name}": f"schema_of_variant({value})", f"_t_{self.name}": text}
        return found if isinstance(self.dtype, T.StringType) else found | {f"_v_{self.name}": value}

    def _converted(self) -> str:
        """The value read as the declared number or boolean type."""
        kind = self.dtype.simpleString()
        read = f"try_variant_get({self.value}, '$', '{kind}')"
        if isinstance(self.dtype, T.DoubleType):
            whens = (f"WHEN {self.kind} IN ('BIGINT', 'DOUBLE') OR startswith({self.kind}, 'DECIMAL') THEN try_cast({self.text} AS double) "
                     f"WHEN {self.kind} = 'BOOLEAN' THEN CASE {self.text} WHEN 'true' THEN 1.0D ELSE 0.0D END")
        elif isinstance(self.dtype, T.BooleanType):
            whens = f"WHEN {self.kind} = 'BOOLEAN' THEN {self.text} = 'true' WHEN {self.kind} = 'BIGINT' THEN {self.text} <> '0'"
        else:
            whens = f"WHEN {self.kind} = 'BIGINT' THEN try_cast({self.text} AS {kind})"
        return f"CASE WHEN {self.kind} = 'VOID' THEN NULL {whens} ELSE {read} END"

    def _from_text(self) -> str:
        """Text of a number, without blanks, underscores and a fraction of zeros, as the declared type."""
        text = self.text
        if not isinstance(self.dtype, T.DoubleType):
            text = f"regexp_replace({text}, r'{ZERO_FRACTION}', '')"
        return f"try_cast(regexp_replace({text}, r'{BLANKS}', '') AS {self.dtype.simpleString()})"

    def fits(self) -> str:
        kind, d = self.kind, self.dtype
        if isinstance(d, T.StringType):
            return f"{kind} IN ('VOID', 'STRING')"
        if isinstance(d, T.ArrayType):
            return f"{kind} IN ('VOID', '{OBJECT_LIST}')"
        if isinstance(d, T.DoubleType):
            text, other = f"{self.text} RLIKE r'{FLOAT_PATTERN}'", self.scalar
        elif isinstance(d, T.BooleanType):
            text = f"lower({self.text}) IN {_quoted(TRUE_WORDS + FALSE_WORDS)}"
            other = (f"CASE WHEN {kind} IN ('VOID', 'BOOLEAN') THEN true WHEN {kind} = 'BIGINT' THEN {self.text} IN ('0', '1') "
                     f"ELSE {self.scalar} AND {self.number} IN (0, 1) END")
        elif isinstance(d, (T.IntegerType, T.LongType)):
            text = f"{self.text} RLIKE r'{INTEGRAL_PATTERN}' AND {self._from_text()} IS NOT NULL"
            whole = f"{self.number} = floor({self.number}) AND {self._converted()} IS NOT NULL"
            other = (f"CASE WHEN {kind} IN ('VOID', 'BOOLEAN') THEN true WHEN {kind} = 'BIGINT' THEN {self._converted()} IS NOT NULL "
                     f"ELSE {self.scalar} AND {whole} END")
        else:
            raise TypeError(f"no gate rule for {d}")
        return f"coalesce(CASE WHEN {kind} = 'STRING' THEN {text} ELSE {other} END, false)"

    def typed(self) -> str:
        d = self.dtype
        if isinstance(d, T.StringType):
            return f"CASE WHEN {self.kind} = 'STRING' THEN {self.text} END"
        if isinstance(d, T.ArrayType):
            return self.value
        text = f"lower({self.text}) IN {_quoted(TRUE_WORDS)}" if isinstance(d, T.BooleanType) else self._from_text()
        return f"CASE WHEN {self.kind} = 'STRING' THEN {text} ELSE {self._converted()} END"


def _struct_of(paths: list[list[str]], leaf: str) -> str:
    """The type that reads the values at the paths in one pass over an object; a level that is no object gives NULLs."""
    heads: dict[str, list[list[str]]] = {}
    for first, *rest in paths:
        heads.setdefault(first, []).append(rest)
    parts = [f"`{head}`:{leaf if rests == [[]] else _struct_of(rests, leaf)}" for head, rests in heads.items()]
    return f"struct<{','.join(parts)}>"


def gate(
    df: DataFrame,
    schema: T.StructType,
    paths: dict[str, str],
    record: str = RECORD,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Typed columns of ``schema``, ``gate_ok``, and ``gate_errors``, the names of the fields that do not fit.

    Columns named in ``keep`` are carried along, the record itself too, so that a reject can
    be stored with its cause. A record that is not a JSON object has the single error ``record``.
    Paths are plain ones, ``$.name`` or ``$.name.name``, and none leads through another's value.
    """
    fields = [_Field(f.name, paths[f.name], f.dataType) for f in schema.fields]
    steps = {f.name: f.path.removeprefix("$.").split(".") for f in fields}
    flat = [steps[f.name] for f in fields if not isinstance(f.dtype, T.ArrayType)]
    read = df.select(
        *keep, record, F.try_variant_get(record, "$", _struct_of(list(steps.values()), "variant")).alias("_values"),
        (F.try_variant_get(record, "$", _struct_of(flat, "string")) if flat else F.lit(None)).alias("_texts"))
    look_ups = {"_is_object": "_values IS NOT NULL"}
    for f in fields:
        at = ".".join(f"`{s}`" for s in steps[f.name])
        look_ups |= f.look_ups(f"_values.{at}", f"_texts.{at}")
    values = compute_once(read, [*keep, record], look_ups)

    ok = " AND ".join(["_is_object", *[f.fits() for f in fields]])
    wrong = ", ".join(f"CASE WHEN NOT {f.fits()} THEN '{f.name}' END" for f in fields)
    errors = f"CASE WHEN _is_object THEN array_compact(array({wrong})) ELSE array('{UNREADABLE}') END"
    return values.selectExpr(
        *[f"`{c}`" for c in keep], *[f"{f.typed()} AS `{f.name}`" for f in fields],
        f"{ok} AS {OK}", f"{errors} AS {ERRORS}", f"`{record}`",
    )


def passes() -> Column:
    return F.col(OK)


def accepted(gated: DataFrame, record: str = RECORD) -> DataFrame:
    """Records that passed, without the gate's own columns."""
    return gated.where(passes()).drop(OK, ERRORS, record)


def rejected(gated: DataFrame, keep: tuple[str, ...] = (), record: str = RECORD) -> DataFrame:
    """Records that failed: their text and the fields at fault."""
    return gated.where(~passes()).select(*keep, ERRORS, F.to_json(record).alias("record"))
