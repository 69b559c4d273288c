"""Pipelines on documents, stage by stage, against rows worked out by hand."""

import json

import pytest

from tidemark.sources.documents import DocumentSource
from tidemark.sources.pipelines import apply_pipeline, parse

SCHEMA = "_id bigint, user_id int, kind string, value double, meta struct<os:string,v:int>, tags array<string>, at timestamp"
ROWS = [
    (1, 10, "view", 1.5, ("iOS", 1), ["a", "b"], "2024-01-01 00:00:00"),
    (2, None, "view", None, ("MacOS", None), [], "2024-01-02 00:00:00"),
    (3, 10, None, 4.0, None, None, "2024-01-03 00:00:00"),
    (4, 11, "buy", -2.0, ("iOS", 3), ["b"], None),
    (5, 12, "buy", 0.0, ("Android", 2), ["c", None], "2024-01-05 00:00:00"),
]


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.createDataFrame(ROWS, SCHEMA.replace("at timestamp", "at string"))
    return plain.withColumn("at", plain["at"].cast("timestamp"))


def run(docs, *stages):
    return [r.asDict(recursive=True) for r in apply_pipeline(docs, json.dumps(stages)).collect()]


MATCHES = [
    ({}, [1, 2, 3, 4, 5]),
    ({"user_id": 10}, [1, 3]),
    ({"user_id": None}, [2]),
    ({"user_id": {"$ne": 10}}, [2, 4, 5]),
    ({"user_id": {"$ne": None}}, [1, 3, 4, 5]),
    ({"value": {"$gt": -1, "$lt": 4}}, [1, 5]),
    ({"value": {"$not": {"$gt": 0}}}, [2, 4, 5]),
    ({"kind": {"$in": ["buy", None]}}, [3, 4, 5]),
    ({"kind": {"$nin": ["buy", None]}}, [1, 2]),
    ({"kind": {"$nin": ["buy"]}}, [1, 2, 3]),
    ({"$or": [{"value": {"$gte": 4}}, {"kind": "buy"}]}, [3, 4, 5]),
    ({"$nor": [{"value": {"$gte": 0}}, {"kind": "buy"}]}, [2]),
    ({"$and": [{"kind": "view"}, {"meta.os": {"$regex": "^mac", "$options": "i"}}]}, [2]),
    ({"meta.os": "iOS", "meta.v": {"$lte": 1}}, [1]),
    ({"meta": {"$exists": False}}, [3]),
    ({"nothing": None}, [1, 2, 3, 4, 5]),
    ({"nothing": {"$gt": 1}}, []),
    ({"tags": "b"}, [1, 4]),
    ({"tags": {"$ne": "b"}}, [2, 3, 5]),
    ({"tags": {"$in": ["a", "c"]}}, [1, 5]),
    ({"at": {"$gte": {"$date": "2024-01-02T00:00:00Z"}}}, [2, 3, 5]),
    ({"user_id": {"$in": [{"$numberLong": "11"}, {"$numberInt": "12"}]}}, [4, 5]),
    ({"$expr": {"$gt": ["$value", "$meta.v"]}}, [1, 3]),
]


@pytest.mark.parametrize("test, ids", MATCHES, ids=[json.dumps(t) for t, _ in MATCHES])
def test_match(docs, test, ids):
    assert sorted(r["_id"] for r in run(docs, {"$match": test})) == ids


def test_order_skip_limit(docs):
    assert [r["_id"] for r in run(docs, {"$sort": {"user_id": 1, "_id": -1}})] == [2, 3, 1, 4, 5]
    assert [r["_id"] for r in run(docs, {"$sort": {"user_id": -1, "_id": 1}}, {"$skip": 1}, {"$limit": 3})] == [4, 1, 3]


def test_fields(docs):
    one = {"$match": {"_id": 1}}
    assert run(docs, one, {"$project": {"kind": 1, "meta.os": 1}}) == [{"_id": 1, "kind": "view", "meta": {"os": "iOS"}}]
    assert run(docs, one, {"$project": {"_id": 0, "n": {"$add": ["$value", "$meta.v", 1]}}}) == [{"n": 3.5}]
    left = run(docs, one, {"$project": {"tags": 0, "at": False, "meta.v": 0}})
    assert left == [{"_id": 1, "user_id": 10, "kind": "view", "value": 1.5, "meta": {"os": "iOS"}}]
    assert list(run(docs, one, {"$project": {"_id": 0}})[0]) == ["user_id", "kind", "value", "meta", "tags", "at"]
    assert run(docs, one, {"$replaceRoot": {"newRoot": "$meta"}}) == [{"os": "iOS", "v": 1}]
    assert "tags" not in run(docs, one, {"$unset": ["tags", "nothing"]})[0]
    made = {
        "a": {"$concat": ["$kind", "-", {"$toUpper": "$meta.os"}]},
        "b": {"$cond": [{"$gte": ["$value", 1]}, "high", "low"]},
        "c": {"$ifNull": ["$nothing", {"$literal": "$x"}]},
        "d": {"x": {"$year": "$at"}, "y": {"$size": "$tags"}},
        "e": {"$divide": [{"$multiply": ["$user_id", 3]}, {"$subtract": [10, 4]}]},
    }
    got = run(docs, one, {"$addFields": made})[0]
    assert [got[k] for k in "abcde"] == ["view-IOS", "high", "$x", {"x": 2024, "y": 2}, 5.0]


def test_groups(docs):
    spec = {"_id": "$kind", "n": {"$sum": 1}, "total": {"$sum": "$value"}, "low": {"$min": "$value"}, "m": {"$avg": "$value"}}
    got = {r["_id"]: r for r in run(docs, {"$group": spec})}
    assert got["view"] == {"_id": "view", "n": 2, "total": 1.5, "low": 1.5, "m": 1.5}
    assert got[None]["n"] == 1 and got["buy"]["total"] == -2.0
    nested = run(docs, {"$group": {"_id": {"k": "$kind", "os": "$meta.os"}, "n": {"$count": {}}}})
    assert sorted(r["n"] for r in nested) == [1, 1, 1, 1, 1]
    assert run(docs, {"$group": {"_id": None, "top": {"$max": "$value"}}}) == [{"_id": None, "top": 4.0}]
    assert run(docs, {"$match": {"_id": 0}}, {"$group": {"_id": None, "n": {"$sum": 1}}}) == []
    assert run(docs, {"$match": {"kind": "buy"}}, {"$count": "n"}) == [{"n": 2}]
    assert run(docs, {"$match": {"kind": "none"}}, {"$count": "n"}) == []
    assert run(docs, {"$match": {"_id": 2}}, {"$group": {"_id": 1, "total": {"$sum": "$value"}}}) == [{"_id": 1, "total": 0.0}]


def test_unwind(docs):
    assert [r["tags"] for r in run(docs, {"$unwind": "$tags"}, {"$sort": {"_id": 1, "tags": 1}})] == ["a", "b", "b", None, "c"]
    kept = run(docs, {"$unwind": {"path": "$tags", "preserveNullAndEmptyArrays": True}})
    assert len(kept) == 7


@pytest.mark.parametrize(
    "stage, name",
    [
        ({"$lookup": {}}, "$lookup"),
        ({"$match": {"a": {"$near": 1}}}, "$near"),
        ({"$match": {"$where": "1"}}, "$where"),
        ({"$group": {"_id": "$kind", "x": {"$push": "$value"}}}, "$push"),
        ({"$project": {"x": {"$map": {}}}}, "$map"),
        ({"$addFields": {"x": "$$ROOT"}}, "$$ROOT"),
        ({"$unwind": {"path": "$tags", "includeArrayIndex": "i"}}, "includeArrayIndex"),
    ],
)
def test_unknown_parts_are_refused_by_name(docs, stage, name):
    with pytest.raises(ValueError, match=name.replace("$", r"\$")):
        apply_pipeline(docs, [stage])


def test_malformed_stages():
    with pytest.raises(ValueError):
        parse('[{"$match": {}, "$limit": 1}]')
    assert parse('{"$limit": 1}') == [("$limit", 1)]


def test_filters_and_columns_reach_the_files(spark, docs, tmp_path, plan_of):
    store = DocumentSource(spark, str(tmp_path))
    store.overwrite(docs, "c")
    match = '[{"$match": {"kind": {"$in": ["buy", "view"]}, "value": {"$gt": 0}}}, {"$sort": {"_id": 1}}, {"$limit": 2}]'
    found = store.read_as("c", "_id bigint, kind string, value double", match)
    assert [tuple(r) for r in found.collect()] == [(1, "view", 1.5)]
    plan = plan_of(found)
    assert "In(kind, [buy,view])" in plan and "GreaterThan(value,0" in plan
    assert "TakeOrderedAndProject" in plan and "tags" not in plan
    grouped = '[{"$match": {"value": {"$gte": 0}}}, {"$group": {"_id": "$kind", "n": {"$sum": 1}}}]'
    made = store.read_as("c", "_id string, n int, absent date", grouped, stored=SCHEMA)
    assert sorted((tuple(r) for r in made.collect()), key=str) == [("buy", 1, None), ("view", 1, None), (None, 1, None)]
    plan = plan_of(made)
    assert "GreaterThanOrEqual(value,0" in plan and "ReadSchema: struct<kind:string,value:double>" in plan
    inferred = store.read_as("c", "_id string, n int", grouped)
    assert inferred.count() == 3


def test_a_connector_gets_the_text(spark):
    store = DocumentSource(spark, format="some.connector", database="db")
    with pytest.raises(Exception, match="some.connector"):
        store.read_as("c", "a int", '[{"$lookup": {}}]')
