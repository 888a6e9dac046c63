"""Messages as VARIANT: reasons of quarantine, and the fields of the feed."""

import json

import pytest
from rows import rows_of
from pyspark.sql import functions as F

from breathline.operators import parse, payload

GOOD = {"aqi": 55, "idx": 7, "iaqi": {"pm25": {"v": 1.5}}, "time": {"s": "x", "v": 4_000_000_000}, "city": {"geo": [1, 2.5]}}

CASES = [  # text, reason, bad fields
    (json.dumps({"city": "a", "payload": GOOD}), None, None),
    (json.dumps({"city": "a", "payload": {}}), None, None),
    (json.dumps({"city": "a", "payload": {**GOOD, "aqi": None}}), None, None),
    (json.dumps({"city": "a", "payload": {**GOOD, "new": [1]}, "more": 1}), None, None),
    (json.dumps({"city": 5, "payload": {**GOOD, "dominentpol": 25}}), None, None),
    (json.dumps({"city": "a", "payload": {**GOOD, "iaqi": {"t": {"v": "NaN"}}}}), None, None),
    (json.dumps({"city": "a", "payload": {**GOOD, "city": {"geo": []}}}), None, None),
    (json.dumps({"city": "a", "payload": {**GOOD, "aqi": "-"}}), "bad_field", "aqi"),
    (json.dumps({"city": "a", "payload": {**GOOD, "aqi": 55.5}}), "bad_field", "aqi"),
    (json.dumps({"city": "a", "payload": {**GOOD, "aqi": 4_000_000_000}}), "bad_field", "aqi"),
    (json.dumps({"city": "a", "payload": {**GOOD, "iaqi": {"pm25": 3, "h": {"v": "wet"}}}}), "bad_field", "iaqi.pm25,iaqi.h.v"),
    (json.dumps({"city": "a", "payload": {**GOOD, "city": "Hanoi", "idx": True}}), "bad_field", "idx,city"),
    (json.dumps({"payload": GOOD}), "no_city", None),
    (json.dumps({"city": None, "payload": GOOD}), "no_city", None),
    (json.dumps({"city": "a"}), "no_payload", None),
    (json.dumps({"city": "a", "payload": None}), "no_payload", None),
    (json.dumps({"city": "a", "payload": "Unknown station"}), "no_payload", None),
    ("[1]", "not_object", None), ("null", "not_object", None), ("5", "not_object", None),
    ("", "not_json", None), ("{", "not_json", None), ('{"city":"a","city":"b"}', "not_json", None), (None, "not_json", None),
    (json.dumps({"city": "a", "payload": {"aqi": 1, "long": "x" * 1_000_000}}), None, None),
]


@pytest.fixture(scope="module")
def cases(spark):
    rows = [(number, text) for number, (text, _, _) in enumerate(CASES)]
    made = spark.createDataFrame(rows, "offset long, text string").withColumns({
        "value": F.col("text").cast("binary"), "timestamp": F.lit("2024-01-01").cast("timestamp"),
        **{name: F.lit("clash") for name in ("reason", "bad_fields", "whole", "path", "key")},
    })
    return made.repartition(3)


def test_reasons(cases):
    found = payload.reasons(cases)
    assert sorted(map(tuple, found.select("offset", "reason", "bad_fields").collect())) == [
        (number, reason, bad) for number, (_, reason, bad) in enumerate(CASES)
    ]
    assert {name for name in found.columns if name.startswith("_")} == set()
    assert payload.reasons(cases.limit(0)).count() == 0
    assert payload.reasons(cases.unionByName(cases)).count() == 2 * len(CASES)


def test_reasons_agree_with_the_parser(cases):
    """A bad field is one the parser gives null for and calls a problem."""
    checked = parse.parse_checked(cases, keep=["offset"]).select("offset", "problem")
    both = payload.reasons(cases).join(checked, "offset").where("reason = 'bad_field' or reason is null").collect()
    assert len(both) > 10
    for row in both:
        if row["bad_fields"] is None or "city" not in row["bad_fields"].split(","):
            assert row["problem"] == row["reason"], row["text"][:80]


def test_fields(spark):
    texts = [json.dumps({"city": "a", "payload": one}) for one in (
        {"x": 1, "o": {"p": {"q": {"r": 1}}, "t": "s"}}, {"x": None, "e": {}}, {"x": 1.5, "l": [{"z": 1}], "f": True}, "no object",
    )] + ["broken", json.dumps({"payload": {"x": "text"}})]
    rows = spark.createDataFrame([(text,) for text in texts], "text string").select(F.col("text").cast("binary").alias("value"))
    assert rows_of(payload.payload_fields(rows), "city", "field", "kind", "messages") == sorted([
        ("a", "x", "number", 2), ("a", "x", "none", 1), ("a", "o", "object", 1), ("a", "o.p", "object", 1),
        ("a", "o.p.q", "object", 1), ("a", "o.t", "text", 1), ("a", "e", "object", 1), ("a", "l", "array", 1),
        ("a", "f", "flag", 1), (None, "x", "text", 1),
    ], key=str)
    assert payload.payload_fields(rows.limit(0)).count() == 0
    assert payload.payload_fields(rows, depth=1).where("field like '%.%'").count() == 0
