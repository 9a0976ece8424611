"""Strict JSON, parsing ladders, retry and default paths of the model call."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tripleweave.functions import json as J
from tripleweave.operators import inference


def one(spark, text, expr):
    return spark.createDataFrame([(text,)], "s string").select(F.to_json(expr(F.col("s")))).first()[0]


@pytest.mark.parametrize("text", [
    '{"a":1}', "[1,2]", '"x"', "1", "null", "true", ' {"a": [1, {"b": null}]} ',
    '{"a":1} x', "1,2", "[1],[2]", "", " ", "{", "]", '{"a":1}}', '1,"__end":1} x', '1,"x"] y', "nope", '{"a":}', "[1] 2",
])
def test_strict_json(spark, text):
    got = one(spark, text, J.strict_json)
    try:
        want = json.loads(text)
    except ValueError:
        assert got is None
    else:
        assert got is not None and json.loads(got) == want


TRIPLE = [["a", "b", "c"]]
TRIPLETS = [
    ('[["a","b","c"]]', TRIPLE, TRIPLE),
    ('```json\n[["a","b","c"]]\n```', TRIPLE, TRIPLE),
    ('Result: ["a","b","c"]', None, TRIPLE),
    ('["a","b","c"]', ["a", "b", "c"], ["a", "b", "c"]),
    ("< a, b, c >", None, []),
    ('[["a","b"] x', None, []),
    ('so [\n["a","b","c"] ]. Done', TRIPLE, TRIPLE),
    ('see [] here', None, []),
]


@pytest.mark.parametrize("text,strict,lenient", TRIPLETS)
def test_triplet_ladders(spark, text, strict, lenient):
    got = one(spark, text, J.parse_array_strict)
    assert (got and json.loads(got)) == strict
    assert json.loads(one(spark, text, J.parse_array_lenient)) == lenient


X = {"Location": ["x"]}
OBJECTS = [
    ('{"Location":["x"]}', X, X),
    ('ok {"Location":["x"]}', X, X),
    ('{"Location":["x"]} done', X, X),
    ('```json\n{"Location":["x"]}\n```', X, X),
    ('first {"Location":["x"]} then {"b":1} end', X, {}),
    ('list [["x"]]', [["x"]], {}),
    ("no json", None, {}),
]


@pytest.mark.parametrize("text,strict,lenient", OBJECTS)
def test_object_ladders(spark, text, strict, lenient):
    got = one(spark, text, J.parse_object_strict)
    assert (got and json.loads(got)) == strict
    assert json.loads(one(spark, text, J.parse_object_lenient)) == lenient


def test_entities_error_and_default(spark):
    df = spark.createDataFrame([(1, "no json"), (2, "{}"), (3, '{"Location":["x"],"n":3}')], "rec int, response string")
    strict = {r.rec: r for r in inference.parse_entities(df, "strict").collect()}
    assert strict[1].error and strict[1].raw == "no json" and strict[1].entities is None
    assert strict[2].error is None and strict[2].entities == {}
    assert strict[3].entities == {"Location": ["x"]}
    lenient = {r.rec: r for r in inference.parse_entities(df, "lenient").collect()}
    assert len(lenient[1].entities) == 5 and not any(lenient[1].entities.values())
    assert len(lenient[2].entities) == 5 and lenient[1].error is None


def test_retry_waits_double(monkeypatch):
    waits, calls = [], []
    monkeypatch.setattr(inference.time, "sleep", waits.append)

    def model(messages):
        calls.append(1)
        if len(calls) < 5:
            raise RuntimeError("busy")
        return "done"

    assert inference.call_with_retry(model, [], 5, 1.0) == "done"
    assert waits == [1.0, 2.0, 4.0, 8.0]
    calls.clear()
    with pytest.raises(RuntimeError):
        inference.call_with_retry(model, [], 3, 0.0)


def failing_model():
    def answer(messages):
        raise RuntimeError("down")

    return answer


def test_failure_modes(spark):
    df = spark.sql("select array(struct('user' as role, 'hi' as content)) as messages")
    ask = lambda **o: inference.infer(df, failing_model, tries=2, wait=0.0, **o).first()
    assert ask(on_error="default", default="{}").response == "{}"
    assert ask(on_error="record").failure == "down"
    with pytest.raises(Exception, match="down"):
        ask(on_error="raise")


def test_python_json(spark):
    value = {"Location": ['a"b', "城"], "Concept": []}
    df = spark.createDataFrame([(value,)], "m map<string,array<string>>")
    text = df.select(J.python_json(F.col("m"))).first()[0]
    assert json.loads(text) == value
    assert text in (json.dumps(value, ensure_ascii=False), json.dumps(dict(reversed(value.items())), ensure_ascii=False))


ODD = [
    "1.50", "-0.0", "-0", "1e3", "1E400", "-1e-400", "1e16", "1.5e-07", "0.00001", "0.0001", "0.00012345678901", "12345678901234567890", "1" * 38,
    "1" * 39, "-" + "9" * 45, "0.1000000000000000055511151231257827", "123456789.123456789", "1e22", "123e-7", "1.7976931348623157e308", "NaN",
    "Infinity", "-Infinity", "0.0", "-0.5", "100.0", "9007199254740993.0", "1e0", "1.0E+2", "1234567.25", "12345678.5", "99999999999999990.0",
    "2e-44", "4.35e-10", "true", "null", '"1e5"', "01", "1.", "-", ".5", "+1", "nan", "1e", "0x1", "-NaN", "Infinity5",
]


def some_numbers():
    rng = random.Random(2)
    for _ in range(150):
        yield repr(rng.choice([rng.random(), rng.random() * 10 ** rng.randint(-20, 25), rng.uniform(-1e7, 1e7)]))
        yield "%.*f" % (rng.randint(1, 20), rng.uniform(-1000, 1000))


@pytest.mark.parametrize("before, after, parse", [
    ('[["a,1e5 -0.0 \\" NaN", ', ', "é"]]', J.parse_array_strict), ('x [["h", ', ', "t"]] y', J.parse_array_strict),
    ('```json\n[["h",', ',"t"]]\n```', J.parse_array_lenient), ('say ["h",\n', '\n,"t"] NaN', J.parse_array_lenient),
])
def test_numbers_are_taken_and_shown_as_python_does(spark, before, after, parse):
    tokens = list(dict.fromkeys([*ODD, *some_numbers()]))
    value = parse(F.concat(F.lit(before), F.col("t"), F.lit(after)))
    df = spark.createDataFrame([(t,) for t in tokens], "t string").select("t", value.alias("v"))
    rows = df.select("t", F.transform(J.triple_items(F.col("v")), lambda x: F.array(x["head"], x["rel"], x["tail"])).alias("x")).collect()
    for r in rows:
        text = before + r.t + after
        text = text[text.index("[") : text.rindex("]") + 1]
        try:
            want = json.loads(text)
            want = [list(map(str, x)) for x in (want if isinstance(want[0], list) else [want])]
        except ValueError:
            want = []
        assert r.x == want, r.t


@pytest.mark.parametrize("text", [
    '{"a":1,"a":2}', '{"L":["x"],"C":["y"],"L":["z"]} ', '{"a":1,"a":2} x', '{"a":"\\"a\\":"}', '{"a":[1],"b":{"a":3}}', "{}", '{"a":1,"b":2,"a":[]}',
    '{"é \\" ":1,"é \\" ":"2"}', '{"a":1,"a"}',
])
def test_the_last_of_equal_keys_counts(spark, text):
    got = one(spark, text, J.strict_json)
    try:
        assert json.loads(got) == json.loads(text)
    except (ValueError, TypeError):
        assert got is None
        with pytest.raises(ValueError):
            json.loads(text)
