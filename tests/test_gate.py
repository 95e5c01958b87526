"""The type gate on JSON text."""

from __future__ import annotations

import json
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furlong.functions.gate import accepted, gate, rejected
from furlong.plans import markets
from furlong.schemas import BOOK, CATALOGUE
from furlong.sources.audit import run_counts
from furlong.sources.landing import records

TYPES = {"s": T.StringType(), "d": T.DoubleType(), "i": T.IntegerType(), "n": T.LongType(), "b": T.BooleanType(),
         "r": T.ArrayType(T.VariantType())}
SCHEMA = T.StructType([T.StructField(k, v) for k, v in TYPES.items()])
PATHS = {k: f"$.{k}" for k in TYPES}

ACCEPTED = {
    "s": [('"x"', "x"), ("null", None), ('""', "")],
    "d": [("1.5", 1.5), ('"12.5"', 12.5), ("true", 1.0), ("false", 0.0), ("3", 3.0), ('" 1_000 "', 1000.0), ("null", None)],
    "i": [("2", 2), ("2.0", 2), ('"2"', 2), ("true", 1), ('"2.0"', 2), ("null", None), ('" 7 "', 7)],
    "n": [("9999999999", 9999999999), ('"9999999999"', 9999999999)],
    "b": [("true", True), ("0", False), ("1", True), ('"yes"', True), ('"OFF"', False), ("1.0", True), ("null", None)],
    "r": [("[]", 0), ('[{"a":1},{}]', 2), ("null", None)],
}
REFUSED = {
    "s": ["5", "true", "{}", "[]"],
    "d": ['"abc"', "{}", '"1.5d"', "[1]", '""'],
    "i": ["1.5", '"abc"', '"1.5"', "{}", "9999999999"],
    "n": ['"x"', "[]"],
    "b": ["7", '"maybe"', "{}", "0.5"],
    "r": ["[1]", '[{"a":1}, null]', "{}", '"x"', "[{}, 2]"],
}


def gated(spark, objects):
    df = spark.createDataFrame([(i, f"[{o}]") for i, o in enumerate(objects)], "row int, body string")
    return gate(records(df, ("row",)), SCHEMA, PATHS, keep=("row",))


@pytest.mark.parametrize("field", list(TYPES))
def test_accepts_and_converts(spark, field):
    cases = ACCEPTED[field]
    df = accepted(gated(spark, [f'{{"{field}": {text}}}' for text, _ in cases]))
    value = F.when(F.col("r").isNotNull(), F.size("r")) if field == "r" else F.col(field)
    got = {r[0]: r[1] for r in df.select("row", value).collect()}
    assert got == {i: v for i, (_, v) in enumerate(cases)}


@pytest.mark.parametrize("field", list(TYPES))
def test_refuses(spark, field):
    df = gated(spark, [f'{{"{field}": {text}}}' for text in REFUSED[field]])
    assert accepted(df).count() == 0
    assert {tuple(r[0]) for r in df.select("gate_errors").collect()} == {(field,)}


def test_missing_fields_pass_and_unknown_ones_go(spark):
    df = accepted(gated(spark, ['{"other": {"deep": [1]}}']))
    assert df.columns == ["row", *TYPES] and df.count() == 1


def test_one_wrong_field_refuses_the_record(spark):
    r = rejected(gated(spark, ['{"s": 1, "d": "x", "i": 3}']), keep=("row",)).first()
    assert r.gate_errors == ["s", "d"] and json.loads(r.record)["i"] == 3


def test_nothing_is_lost(spark):
    bodies = ["[{}, 3, null, {\"s\": 1}]", "not json", "{}", "[]", None, "[[1]]"]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    g = gate(records(df), SCHEMA, PATHS)
    # Four elements; three bodies without an array; none; one list in a list.
    assert g.count() == 8
    assert accepted(g).count() == 1 and rejected(g).count() == 7
    assert run_counts(g).first().asDict() == {"success": 1, "failed": 7}


def market(**changes):
    base = {
        "marketId": "1.1", "marketName": "R1", "marketStartTime": "2026-05-01T02:00:00.000Z", "totalMatched": 1.5,
        "eventType": {"id": "7", "name": "n"}, "event": {"id": "e", "countryCode": "AU", "venue": "v"},
        "competition": {"id": "c", "name": "cup"},
        "description": {"bettingType": "ODDS", "marketType": "WIN", "eachWayDivisor": 4, "turnInPlayEnabled": True, "rules": "r"},
        "runners": [{"selectionId": 1, "runnerName": "a", "sortPriority": 1}],
    }
    return {**base, **changes}


def test_catalogue_flattens_19_columns(spark):
    body = json.dumps([market(), market(marketId="1.2", competition=None), market(marketId=5), market(event={"countryCode": "NZ"})])
    df = markets.catalogue(spark.createDataFrame([(body,)], "body string"))
    assert df.columns == CATALOGUE.names and len(df.columns) == 19
    got = {r.market_id: (r.event_venue, r.competition_name, r.each_way_divisor, r.turn_in_play) for r in df.drop("runners").collect()}
    assert got == {"1.1": ("v", "cup", 4.0, True), "1.2": ("v", None, 4.0, True)}


def test_book_has_11_columns(spark):
    body = json.dumps([{"marketId": "1.1", "status": "OPEN", "betDelay": 0, "version": 5000000000, "complete": True, "runners": [{"x": 1}]}])
    responses = spark.createDataFrame([(body,)], "body string")
    catalogue = spark.createDataFrame([("1.1",), ("",), (None,)], "market_id string")
    df = markets.book(responses, catalogue)
    assert df.columns == BOOK.names and df.first().version == 5000000000
    assert markets.book(responses, catalogue.where("market_id = ''")).count() == 0


def test_runners_flat_keeps_empty_markets(spark):
    body = json.dumps([market(), market(marketId="1.2", runners=[]), market(marketId="1.3", runners=None)])
    flat = markets.flat_runners(markets.catalogue(spark.createDataFrame([(body,)], "body string")), markets.CATALOGUE_RUNNER, ("market_id",))
    assert sorted((r.market_id, r.selection_id) for r in flat.collect()) == [("1.1", 1), ("1.2", None), ("1.3", None)]


def test_levels_that_are_no_objects_and_rare_kinds(spark):
    """A level on the way that is no object counts as missing; kinds that few values have are converted as before."""
    schema = T.StructType([T.StructField("s", T.StringType()), T.StructField("d", T.DoubleType()), T.StructField("n", T.LongType()), T.StructField("b", T.BooleanType())])
    paths = {"s": "$.x.s", "d": "$.x.y.d", "n": "$.n", "b": "$.x.b"}
    bodies = ['{"x": 5}', '{"x": [1]}', '{"x": null, "n": 12345678901234567}', '{"x": {"s": "é\\"", "y": {"d": 1e300}, "b": 1.0}, "n": 3.0}',
              '{"x": {"y": {"d": 0.1}, "b": false}, "n": 1e3}', '{"x": {"y": {"d": {}}}}', '{"x": {"s": {}}}', '{"n": 1e30}', '{"x": {"b": 2.0}}']
    df = spark.createDataFrame([(i, f"[{b}]") for i, b in enumerate(bodies)], "row int, body string")
    out = gate(records(df, ("row",)), schema, paths, keep=("row",))
    assert sorted(tuple(r) for r in accepted(out).collect()) == [
        (0, None, None, None, None), (1, None, None, None, None), (2, None, None, 12345678901234567, None), (3, 'é"', 1e300, 3, True), (4, None, 0.1, 1000, False)]
    assert {r.row: r.gate_errors for r in rejected(out, ("row",)).collect()} == {5: ["d"], 6: ["s"], 7: ["n"], 8: ["b"]}


def test_no_method_of_the_gate_runs_uncompiled(spark):
    """The JVM leaves methods of over 8,000 bytes to its interpreter; stages with such a method are not generated whole."""
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_a_value_is_read_as_a_plain_type_once(spark):
    """Reading a VARIANT is what the gate spends its time on: values are read as text with the record, not again for each rule."""
    df = spark.createDataFrame([("[{}]",)], "body string")
    plan = accepted(markets.gated_book(df))._jdf.queryExecution().optimizedPlan().toString()
    assert not re.findall(r"try_variant_get\(_v_\w+#\d+, \$, StringType", plan)
