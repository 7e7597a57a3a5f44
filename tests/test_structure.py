"""Paths and types of documents against a walk in plain Python."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tierwise.operators.structure import path_types, structure_drift


def kind(value):
    if value is None or isinstance(value, bool):
        return "null" if value is None else "boolean"
    if isinstance(value, (int, float)):
        return "whole" if value == int(value) else "fraction"
    return {str: "string", list: "array", dict: "object"}[type(value)]


def walk(value, path="$"):
    yield path, kind(value)
    if isinstance(value, dict):
        for key, member in value.items():
            yield from walk(member, f"{path}.{key}")
    if isinstance(value, list):
        for item in value:
            yield from walk(item, path + "[]")


def expected(documents):
    values, documents_with = Counter(), Counter()
    for group, text in documents:
        if text is not None:
            nodes = [(group, *n) for n in walk(json.loads(text))]
            values.update(nodes)
            documents_with.update(set(nodes))
    return {(*node, documents_with[node], n) for node, n in values.items()}


def random_value(rng, depth):
    if depth and rng.random() < 0.6:
        if rng.random() < 0.5:
            return [random_value(rng, depth - 1) for _ in range(rng.randrange(4))]
        return {rng.choice("abcdef"): random_value(rng, depth - 1) for _ in range(rng.randrange(4))}
    return rng.choice([None, True, 1, -7, 2.5, 3.0, 1e300, "", "x", 2**40])


def table(spark, documents):
    return spark.createDataFrame(documents, "g string, j string").select("g", F.try_parse_json("j").alias("d"))


@pytest.mark.parametrize("depth", [3, 11])
def test_paths_equal_a_walk(spark, depth):
    """Also of documents that one pass does not open to the end."""
    rng = random.Random(depth)
    documents = [(rng.choice(["x", "y", None]), json.dumps(random_value(rng, depth))) for _ in range(150)]
    documents += [("x", None), ("x", documents[0][1]), ("x", documents[0][1]), ("y", "{}"), ("y", "[]"), (None, '[[[[[[[[[{"a": [1, 1]}]]]]]]]]]')]
    got = path_types(table(spark, documents), "d", by=["g"]).collect()
    assert len(got) == len({r[:3] for r in got})
    assert {tuple(r) for r in got} == expected(documents)


def test_many_values_of_one_document(spark):
    documents = [("x", json.dumps({"a": list(range(20000)) + ["t"] * 5}))]
    got = {tuple(r) for r in path_types(table(spark, documents), "d").collect()}
    assert got == {("$", "object", 1, 1), ("$.a", "array", 1, 1), ("$.a[]", "whole", 1, 20000), ("$.a[]", "string", 1, 5)}


def test_no_documents(spark):
    assert path_types(table(spark, [("x", None)]), "d", by=["g"]).collect() == []
    assert path_types(table(spark, []), "d").collect() == []


def test_drift(spark):
    before = path_types(table(spark, [("", '{"a": 1, "b": 2, "c": [1]}'), ("", '{"a": 3}')]), "d")
    after = path_types(table(spark, [("", '{"a": "1", "c": [1], "e": {"f": null}}')]), "d")
    got = {tuple(r) for r in structure_drift(before, after).collect()}
    assert got == {
        ("$", "object", "kept", 2, 1), ("$.a", "whole", "retyped", 2, 0), ("$.a", "string", "retyped", 0, 1),
        ("$.b", "whole", "lost", 1, 0), ("$.c", "array", "kept", 1, 1), ("$.c[]", "whole", "kept", 1, 1),
        ("$.e", "object", "added", 0, 1), ("$.e.f", "null", "added", 0, 1),
    }


def test_only_counts_and_deeper_nodes_are_stored(spark, monkeypatch):
    """The nodes of a document are counted where it is read, not written out."""
    from tierwise.operators import structure

    stored, cut = [], structure.cut_lineage
    monkeypatch.setattr(structure, "cut_lineage", lambda df: stored.append(df.columns) or cut(df))
    texts = ['{"a":[{"b":1},{"b":null}]}', '{"a":{"a":{"a":{"a":{"a":[1, 1.5]}}}}}']
    docs = spark.createDataFrame([(t,) for t in texts], "t string").select(F.parse_json("t").alias("doc"))
    got = {tuple(r) for r in path_types(docs, "doc").collect()}
    assert got == {n[1:] for n in expected([(None, t) for t in texts])}
    counts = ["path", "kind", "n_documents", "n_values"]
    assert stored == [counts, ["_open"], counts]
