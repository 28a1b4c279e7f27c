"""Landed bodies: documents, rejects and fields that nobody declared."""

import json

import pytest
from pyspark.sql import functions as F

from shelfcast.sources import responses
from shelfcast.sources.landed_json import parse_response

BODIES = [
    ('{"a": 1}', None),
    (' \n{"a": 1}\t', None),
    ("{}", None),
    ('{"a": 1, "a": 2}', None),
    (None, responses.EMPTY),
    ("", responses.EMPTY),
    (" \n", responses.EMPTY),
    ('{"a": 1', responses.NOT_JSON),
    ('{"a": 1} x', responses.NOT_JSON),
    ('{"a": 1}}', responses.NOT_JSON),
    ('{"a": 1}],[', responses.NOT_JSON),
    ('{"a": 1},{"b": 2}', responses.NOT_JSON),
    ('{"a": 1},"k":{}', responses.NOT_JSON),
    ("{'a': 1}", responses.NOT_JSON),
    ("<html>busy</html>", responses.NOT_JSON),
    ("[1]", responses.NOT_AN_OBJECT),
    ('[{"a": 1}]', responses.NOT_AN_OBJECT),
    ('"text"', responses.NOT_AN_OBJECT),
    ("null", responses.NOT_AN_OBJECT),
    ("7", responses.NOT_AN_OBJECT),
]


def is_object(body):
    try:
        return isinstance(json.loads(body or ""), dict)
    except ValueError:
        return False


def test_a_body_is_a_document_or_a_reject(spark):
    frame = spark.createDataFrame([(i, b) for i, (b, _) in enumerate(BODIES)], "i int, body string")
    why = {r.i: r.reason for r in responses.rejects(frame, "body", {"i": "i"}).collect()}
    kept = {r.i for r in frame.where(responses.document("body").isNotNull()).collect()}
    for i, (body, reason) in enumerate(BODIES):
        assert why.get(i) == reason, body
        assert (i in kept) == (reason is None) == is_object(body), body


def test_broken_bodies_give_no_row(spark):
    frame = spark.createDataFrame([(1, '{"a": 5}'), (2, '{"a": '), (3, '{"a": "x"}')], "i int, body string")
    got = parse_response(frame, "body", "a int", {"i": "i"}).sort("i").collect()
    assert [(r.i, r.a) for r in got] == [(1, 5), (3, None)]


def found(spark, bodies, **lineage):
    frame = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string")
    rows = responses.discovered_rows(frame, "body", {"i": "i", **lineage}, "$.list")
    return rows, [r.asDict(recursive=True) for r in rows.sort("i").collect()]


def test_fields_of_all_rows_are_found_and_their_types_merged(spark):
    rows, got = found(
        spark,
        [
            '{"A": {"b.c": 1, "D e": true}, "n": 1}',
            '{"A": {"b.c": 2.5}, "n": 12345678901234567890123}',
            '{"late": {"only": "here"}, "z": null}',
            "{}",
            "broken",
        ],
    )
    assert dict(rows.dtypes) == {
        "i": "int", "a_b_c": "double", "a_d e": "boolean", "late_only": "string", "n": "decimal(38,0)", "z": "string",
    }
    assert [r["a_b_c"] for r in got] == [1.0, 2.5, None, None]
    assert [r["n"] for r in got] == [1, 12345678901234567890123, None, None]
    assert got[2]["late_only"] == "here" and got[0]["a_d e"] is True


def test_fields_of_different_kinds_keep_their_values(spark):
    rows, got = found(
        spark,
        [
            '{"x": "text", "y": [1, "a"], "e": {}}',
            '{"x": {"deep": 1, "mixed": {"p": 2}}, "y": [2]}',
            '{"x": {"deep": "two", "mixed": "m"}, "y": 3}',
            '{"x": 7.5}',
        ],
    )
    assert [r["x"] for r in got] == ["text", None, None, "7.5"]
    assert [r["x_deep"] for r in got] == [None, "1", "two", None]
    assert [r["x_mixed"] for r in got] == [None, None, "m", None]
    assert [r["x_mixed_p"] for r in got] == [None, 2, None, None]
    assert [r["y"] for r in got] == ['[1,"a"]', "[2]", "3", None]
    assert [r["e"] for r in got] == ["{}", None, None, None]


def test_services_are_rows_and_lineage_wins(spark):
    rows, got = found(
        spark,
        [
            '{"i": 99, "list": [{"id": 1, "cost": {"amount": 2}}, {"id": 2, "new": "f"}], "q": 1}',
            '{"i": 98, "list": []}',
            '{"list": "none"}',
            '{"list": [5]}',
            '{"Q": 4}',
        ],
    )
    assert sorted((r["i"], r["services_id"], r["services_cost_amount"], r["services_new"], r["q"]) for r in got if r["i"] == 0) == [
        (0, 1, 2, None, 1), (0, 2, None, "f", 1),
    ]
    assert [(r["i"], r["services_id"]) for r in got if r["i"]] == [(1, None), (2, None), (3, None), (4, None)]
    assert got[-1]["q"] == 4  # q and Q fall together


def test_names_that_differ_in_case_only(spark):
    _, got = found(spark, ['{"o": {"P": {"u": 1}, "p": {"u": 2, "U": 3}, "w": 4}}', '{"o": {"p": {"u": "five"}}}'])
    assert sorted(got[0].items()) == [("i", 0), ("o_p_u", "1"), ("o_w", 4)]
    assert got[1]["o_p_u"] == "five"


def test_no_rows_have_no_fields(spark):
    for bodies in ([], ["broken"]):
        frame = spark.createDataFrame([(1, b) for b in bodies], "i int, body string")
        assert responses.discovered_rows(frame, "body", {"i": F.col("i")}).columns == ["i"]


def test_one_aggregate_discovers_where_kinds_agree(spark):
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("discovery", "")
    frame = spark.createDataFrame([(1, '{"a": {"b": 1}, "list": [{"c": 2}]}')], "i int, body string")
    responses.discovered_rows(frame, "body", {"i": "i"}, "$.list")
    assert 1 <= len(jobs.getJobIdsForGroup("discovery")) <= 2  # the stages of one adaptive query
    spark.sparkContext.setJobGroup("", "")


@pytest.mark.parametrize("name", ["a`b", "c'd", 'e"f', "g[0]", "h$.i", "OBJECT<"])
def test_odd_field_names(spark, name):
    _, got = found(spark, [json.dumps({name: {"x": 3}})])
    assert got[0][(name + "_x").lower().replace(".", "_")] == 3
