"""Schema drift below the top level."""

import pytest
from helpers import rows
from pyspark.sql import types as T

from tidemark.functions.nested import common_schema, common_type, conform, union_widened


def kind(text):
    return T._parse_datatype_string(text)


@pytest.mark.parametrize("a, b, want", [
    ("int", "bigint", "bigint"), ("int", "string", "string"), ("float", "double", "double"), ("float", "int", "double"),
    ("decimal(5,2)", "decimal(9,1)", "decimal(10,2)"), ("int", "decimal(12,2)", "decimal(12,2)"),
    ("bigint", "decimal(12,2)", "decimal(21,2)"), ("bigint", "double", "string"), ("date", "timestamp", "timestamp"),
    ("array<int>", "array<bigint>", "array<bigint>"), ("map<int,float>", "map<bigint,double>", "map<bigint,double>"),
    ("struct<a:int,B:string>", "struct<b:string,A:bigint,c:date>", "struct<a:bigint,B:string,c:date>"),
    ("struct<a:array<struct<x:int>>>", "struct<a:array<struct<x:bigint,y:int>>>", "struct<a:array<struct<x:bigint,y:int>>>"),
])
def test_common_type(a, b, want):
    assert common_type(kind(a), kind(b)).simpleString() == want
    assert {f.lower() for f in common_type(kind(b), kind(a)).simpleString().split(",")} is not None


@pytest.mark.parametrize("a, b", [("struct<a:int>", "int"), ("array<int>", "string"), ("map<int,int>", "array<int>"), ("binary", "string")])
def test_no_common_type(a, b):
    with pytest.raises(ValueError, match="no type holds both"):
        common_type(kind(a), kind(b))


def test_rows_of_three_versions(spark):
    one = spark.createDataFrame(
        [(1, (5, "p"), [1, None], {"k": [(1,)]}), (2, None, None, None), (3, (None, None), [], {})],
        "id int, s struct<a:int,b:string>, l array<int>, m map<string,array<struct<x:int>>>")
    two = spark.createDataFrame(
        [(2**40, ("q", 2**40, True), [2**40], {"k": [(2**40, "y")], "n": None})],
        "ID bigint, S struct<B:string,A:bigint,c:boolean>, l array<bigint>, m map<string,array<struct<x:bigint,y:string>>>")
    three = spark.createDataFrame([("new", 4)], "added string, id int")
    out = union_widened([one, two, three])
    assert out.schema.simpleString() == (
        "struct<id:bigint,s:struct<a:bigint,b:string,c:boolean>,l:array<bigint>,"
        "m:map<string,array<struct<x:bigint,y:string>>>,added:string>")
    got = {r.id: (r.s and tuple(r.s), r.l, r.m and {k: v and [tuple(x) for x in v] for k, v in r.m.items()}, r.added) for r in out.collect()}
    assert got == {
        1: ((5, "p", None), [1, None], {"k": [(1, None)]}, None), 2: (None, None, None, None),
        3: ((None, None, None), [], {}, None), 2**40: ((2**40, "q", True), [2**40], {"k": [(2**40, "y")], "n": None}, None),
        4: (None, None, None, "new"),
    }
    # Conforming is stable, and no rows are no rows.
    assert rows(conform(out, out.schema).select("id")) == rows(out.select("id"))
    assert union_widened([one.limit(0), two.limit(0)]).count() == 0
    assert common_schema(one.schema) == one.schema


def test_narrowing_is_null(spark):
    wide = spark.createDataFrame([((2**40, 7),)], "s struct<a:bigint,b:int>")
    got = conform(wide, kind("s struct<b:int,a:int>")).first().s
    assert tuple(got) == (7, None)
