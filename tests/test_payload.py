"""Payload columns of changing shape, held against Python's json."""

from __future__ import annotations

import json
from collections import Counter

from locusloom.functions.payload import payload_fields, with_state

TEXTS = [
    '{"stage": "call", "done": 3, "sample": {"name": "s1", "steps": [1, 2]}}',
    '{"stage": 7, "done": "many", "sample": null}',
    '{"done": 2.5, "ok": true}',
    "{}",
    "[1, 2]",
    "5",
    '"text"',
    "null",
    '{"done": 3',
    "",
    "no json",
    None,
    '{"done": 99999999999999999999}',
    '{"note": "' + "x" * 200_000 + '"}',
]
FIELDS = {"done": ("$.done", "bigint"), "stage": ("$.stage", "string"), "name": ("$.sample.name", "string")}


def state_of(text):
    if text is None:
        return None
    try:
        return "object" if isinstance(json.loads(text), dict) else "shape"
    except ValueError:
        return "broken"


def test_states_and_fields(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    got = {r["id"]: r for r in with_state(rows, "text", FIELDS).collect()}
    assert {i: r["state"] for i, r in got.items()} == {i: state_of(t) for i, t in enumerate(TEXTS)}
    assert (got[0]["done"], got[0]["stage"], got[0]["name"]) == (3, "call", "s1")
    assert (got[1]["done"], got[1]["stage"], got[1]["name"]) == (None, "7", None)
    assert got[12]["done"] is None
    assert all(got[i][c] is None for i in (3, 4, 5, 6, 7, 8, 9, 10, 11) for c in FIELDS)
    assert with_state(rows.limit(0), "text", FIELDS).collect() == []


def test_counted_fields(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    kinds = {dict: "object", list: "array", str: "text", int: "number", float: "number", bool: "boolean", type(None): "null"}
    want = Counter((k, kinds[type(v)]) for t in TEXTS if state_of(t) == "object" for k, v in json.loads(t).items())
    assert {(r["field"], r["kind"]): r["n"] for r in payload_fields(rows, "text").collect()} == dict(want)
    assert payload_fields(rows.limit(0), "text").collect() == []
