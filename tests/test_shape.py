"""Explode and flatten, on literals and against a plain recursive definition."""

import json
import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weirgate.operators import documents as D
from weirgate.operators import shape
from weirgate.operators.layout import Layout, infer
from weirgate.operators.records import column


def flat_rows(value, name=""):
    """All flat rows a value stands for: objects multiply, lists add up."""
    if isinstance(value, dict):
        if not value:
            return [{name: None}] if name else [{}]
        rows = [{}]
        for key, inner in value.items():
            parts = flat_rows(inner, f"{name}_{key}" if name else key)
            rows = [a | b for a in rows for b in parts]
        return rows
    if isinstance(value, list):
        if not any(value):
            return [{name: None}]
        return [row for element in value for row in flat_rows(element, name)]
    return [{name: value}]


def spark_rows(spark, documents):
    texts = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(documents)], "n int, value string")
    tagged = D.read_documents(texts, "value")
    layout = infer(tagged, "_document")
    return layout, D.flat_rows(tagged.drop("value", "_error"), "_document", layout)


def as_text(value):
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        return repr(value)
    return None if value is None else str(value)


def comparable(row):
    """Rows without the columns that are NULL, values as text (mixed columns are text)."""
    return frozenset((k, as_text(v)) for k, v in row.items() if v is not None)


def some_value(rng, depth):
    """A random value: objects and lists down to a depth, and scalars, the falsy ones among them."""
    kind = rng.randrange(6 if depth else 3)
    if kind < 3:
        return rng.choice([None, 0, rng.randint(1, 99), "", f"t{rng.randint(0, 9)}"])
    if kind == 3:
        return [some_value(rng, 0) for _ in range(rng.randint(0, 4))]
    if kind == 4:
        return [{f"m{k}": some_value(rng, depth - 1) for k in range(rng.randint(1, 3))} for _ in range(rng.randint(1, 3))]
    return {f"k{k}": some_value(rng, depth - 1) for k in range(rng.randint(1, 3))}


@pytest.mark.parametrize("seed", range(4))
def test_random_documents_against_the_rule(spark, seed):
    """Lists side by side multiply, those inside each other add up, objects join their names."""
    rng = random.Random(seed)
    # Each place has one kind of value in all documents, so that no column is of mixed types.
    documents = [{f"d{n}_{key}": some_value(rng, 2) for key in range(rng.randint(1, 3))} for n in range(12)]
    _, rows = spark_rows(spark, documents)
    found = Counter((r["n"], comparable({k: v for k, v in r.asDict().items() if k != "n"})) for r in rows.collect())
    assert found == Counter((n, comparable(row)) for n, document in enumerate(documents) for row in flat_rows(document))


def test_falsy_lists(spark):
    documents = [{"x": v} for v in ([], [0], [0, 0], ["", False], [None], [{}, {}], [[], []], [0, 1], [{}, {"a": 1}], [0.0])]
    _, rows = spark_rows(spark, documents)
    counts = {r.n: r["count"] for r in rows.groupBy("n").count().collect()}
    assert counts == {0: 1, 1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 2, 8: 2, 9: 1}


def test_typed_lists_with_null_elements_and_empty_structs(spark):
    rows = spark.createDataFrame([(1, [None, 0]), (2, [None, 5]), (3, None)], "n int, x array<int>")
    assert Counter(map(tuple, shape.explode_lists(rows).collect())) == Counter([(1, None), (2, None), (2, 5), (3, None)])


def test_awkward_keys(spark):
    documents = [{"a.b": {"c d": [1, 2]}, "x`y": {"q?": {"z[0]": "v"}}, 'say "hi"': 1, "A": 1, "a": 2}]
    _, rows = spark_rows(spark, documents)
    found = {tuple(sorted(comparable(r.asDict()) - {("n", "0")})) for r in rows.collect()}
    base = [("A", "1"), ("a", "2"), ('say "hi"', "1"), ("x`y_q?_z[0]", "v")]
    assert found == {tuple(sorted([*base, ("a.b_c d", "1")])), tuple(sorted([*base, ("a.b_c d", "2")]))}


def test_empty_keys(spark):
    _, rows = spark_rows(spark, [{"": 1, "a": {"": [1, 2], "b": 3}}])
    assert sorted(rows.select("`a_`", "a_b").collect()) == [(1, 3), (2, 3)]


def test_objects_that_are_sometimes_lists(spark):
    documents = [{"i": {"k": 1}}, {"i": [{"k": 2}, {"k": 3}]}, {"i": 4}, {"i": [5, {"k": [6, 7]}]}]
    _, rows = spark_rows(spark, documents)
    found = Counter((r.n, r.i, r.i_k) for r in rows.collect())
    assert found == Counter([(0, None, 1), (1, None, 2), (1, None, 3), (2, 4, None), (3, 5, None), (3, None, 6), (3, None, 7)])


def test_upper_key_wins_a_collision(spark):
    _, rows = spark_rows(spark, [{"a": {"b": 1}, "a_b": 2}])
    assert rows.select("a_b").collect() == [(2,)]


scalars = st.one_of(st.none(), st.booleans(), st.integers(-5, 5), st.sampled_from(["", "x", "0", "false", "{}"]))
keys = st.sampled_from(["p", "q", "r"])
values = st.recursive(
    scalars, lambda inner: st.one_of(st.lists(inner, max_size=3), st.dictionaries(keys, inner, max_size=3)), max_leaves=6
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(keys, values, max_size=3), min_size=5, max_size=25))
def test_documents_follow_the_definition(spark, documents):
    _, rows = spark_rows(spark, documents)
    got = Counter((r.pop("n"), comparable(r)) for r in (x.asDict() for x in rows.collect()))
    want = Counter((n, comparable(r)) for n, d in enumerate(documents) for r in flat_rows(d))
    assert got == want


def test_layout_of_declared_types_gives_the_same_rows(spark):
    document = {"id": 1, "l": [{"a": 1}, {"a": None}], "m": [[1, 2], [3]]}
    texts = spark.createDataFrame([(json.dumps(document),)], "value string")
    tagged = D.read_documents(texts, "value").drop("value", "_error")
    declared = Layout.of(spark.createDataFrame([], "id int, l array<struct<a:int>>, m array<array<int>>").schema)
    inferred = infer(tagged, "_document")
    columns = ["id", "l_a", "m"]
    one, two = (D.flat_rows(tagged, "_document", x).select(columns).collect() for x in (declared, inferred))
    assert Counter(one) == Counter(two) and len(one) == 6


def test_flatten_one_level_drops_plain_columns(spark):
    rows = spark.createDataFrame([((1, 2), 3)], "a struct<b:int,c:int>, d int")
    assert shape.flatten_one_level(rows).columns == ["a_b", "a_c"]


def test_flatten_keeps_the_upper_of_two_equal_names(spark):
    rows = spark.createDataFrame([((1,), 2)], "a struct<b:int>, a_b int")
    assert shape.flatten(rows, "_").collect() == [(2,)]


def test_json_must_be_one_value(spark):
    texts = ['{"a":1}', ' {"a":1} ', '{"a":1} x', "", "1,2", '{"a":1],[2}', "1] ", "[1]", "null", '{"a":NaN}', '{"a":1,"a":2}']
    rows = D.read_documents(spark.createDataFrame([(t,) for t in texts], "value string"), "value")
    good = [r.value for r in rows.where(column("_error").isNull()).collect()]
    assert good == ['{"a":1}', ' {"a":1} ', "[1]", "null", '{"a":1,"a":2}']
    last = rows.where(F.col("value") == '{"a":1,"a":2}').select(D.at(F.col("_document"), ("a",), "int")).first()
    assert last[0] == 2
