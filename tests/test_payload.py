"""Payload fields against plain Python lookups on random documents."""

import json
import random

import pytest

from foldlog.operators.payload import PAYLOAD_FIELDS, document_fields, flatten_payload, parse_payload

ABSENT = object()
TEXTS = ["", "x", "ñandú ✓", 'quo"te', "back\\slash", "line\nbreak", "{not json", "null", "7"]


FLOATS = [
    0.0, 1.0, -2.5, 0.1, 1.1, 1e5, 123456.75, 1e7, 12345678.9, 1.5e15, 1e16, 1.25e22, 1e100, -3e200,
    0.001, 0.0009765625, 1e-4, 1.5e-4, 1e-5, 1.5e-7, 2.5e-300, 1e18, 12345678901234567000.0,
]


def random_value(rng, depth=0):
    kind = rng.randrange(8 if depth < 2 else 5)
    if kind == 0:
        return None
    if kind == 1:
        return rng.choice([True, False])
    if kind == 2:
        whole = [0, -7, 1_700_000_000, 2**53 + 1, 10**20 + 1, -(10**46) - 3, 10**60 + 7]
        # Inside lists and objects numbers are JSON text, which is not compared here.
        return rng.choice(whole[:4] if depth else whole + FLOATS)
    if kind <= 4:
        return rng.choice(TEXTS)
    if kind == 5:
        return [random_value(rng, depth + 1) for _ in range(rng.randrange(3))]
    return {rng.choice("abcd"): random_value(rng, depth + 1) for _ in range(rng.randrange(3))}


def random_document(rng):
    document = {}
    for path in PAYLOAD_FIELDS.values():
        if rng.random() < 0.3:
            continue
        *parents, leaf = path.split(".")
        node = document
        for parent in parents:
            child = node.setdefault(parent, {})
            if not isinstance(child, dict):
                break
            node = child
        else:
            node[leaf] = random_value(rng)
    for parent in ("analysis", "specialist", "createdBy", "processAt"):
        if rng.random() < 0.15:
            document[parent] = random_value(rng)
    return document


def look_up(document, path):
    for part in path.split("."):
        if not isinstance(document, dict) or part not in document:
            return ABSENT
        document = document[part]
    return document


def as_text(value):
    if value is ABSENT:
        return ""
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, (bool, int, float)):
        return str(value)
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"), sort_keys=True)


def test_random_documents(spark):
    rng = random.Random(7)
    documents = [random_document(rng) for _ in range(400)]
    texts = [json.dumps(d, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1])) for d in documents]
    rows = flatten_payload(spark.createDataFrame(list(enumerate(texts)), "n int, data string")).collect()
    for row in rows:
        for name, path in PAYLOAD_FIELDS.items():
            value = look_up(documents[row.n], path)
            if name == "responsibleWorkshop" and not isinstance(value, dict):
                value = ABSENT
            assert row[name] == as_text(value), (name, texts[row.n])


@pytest.mark.parametrize("text", ['{"a":1}{"b":2}', '{"a":1} x', '{"a":1},{"b":2}', '{"a":1}]', '{"a":1},'])
def test_text_after_the_object_is_malformed(spark, text):
    df = spark.createDataFrame([(text,)], "data string")
    assert parse_payload(df, mode="null").select("__document").first()[0] is None
    with pytest.raises(Exception):
        parse_payload(df).collect()


def test_fields_of_a_kept_column_survive(spark):
    df = spark.createDataFrame([('{"a":{"b":1,"c":{"d":null}}}', 5)], "data string, `odd.name` int")
    fields = {"b": "a.b", "d": "a.c.d", "e": "a.c.e", "c": "a.c", "whole": "a"}
    row = document_fields(parse_payload(df), fields, objects=("c",)).first()
    assert row.asDict() == {
        "data": '{"a":{"b":1,"c":{"d":null}}}',
        "odd.name": 5,
        "b": "1",
        "d": None,
        "e": "",
        "c": '{"d":null}',
        "whole": '{"b":1,"c":{"d":null}}',
    }


@pytest.mark.parametrize("written", ["1.10", "1.0", "-0", "1E3", "1e400", "12345678901234567890.0", "1.0e-10", "5e-324"])
def test_numbers_read_like_python_floats_and_integers(spark, written):
    df = spark.createDataFrame([(f'{{"id": {written}, "a": {{"b": [1], "c": {written}}}}}',)], "data string")
    row = document_fields(parse_payload(df), {"id": "id", "c": "a.c"}, source="data").first()
    assert row.id == row.c == str(json.loads(written))


def test_ids_of_47_digits_stay_apart(spark):
    ids = [10**46 + k for k in range(10)] + [-(10**46) - 1]
    df = spark.createDataFrame([(f'{{"id":{i}}}',) for i in ids], "data string")
    assert [r.id for r in flatten_payload(df).collect()] == [str(i) for i in ids]


def test_a_name_that_is_there_already_is_refused(spark):
    with pytest.raises(ValueError, match="state"):
        flatten_payload(spark.createDataFrame([("{}", 1)], "data string, State int"))
