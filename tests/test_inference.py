"""Schema inference, path profiles and places in a global order."""

import json
import random
from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql import types as T

from plazalens.operators.ranking import with_global_place
from plazalens.sources import infer_schema, line_schema, parse_posts, path_profile, read_posts, undeclared_fields

ROWS = [
    '{"id": 1, "a b": {"x": [1, 2.5], "OBJECT": null}, "t": "s"}', '{"id": 2, "a b": {"x": [{"y": true}]}, "u": {}, "e": []}',
    "broken {", "", " ", "[1]", "7", '{"id": "x", "n": null}', '{"id": 3, "VARIANT": 1.25, "t": null, "d": {"k": {}}}',
    '{"a.b": [[1, null], [], ["z"]]}',
]


def lines(spark, rows):
    return spark.createDataFrame([(row,) for row in rows], "value string").repartition(3)


def test_schema_of_lines(spark):
    row = line_schema(lines(spark, ROWS)).first()
    assert (row.lines, row.malformed) == (8, 3)
    found = infer_schema(lines(spark, ROWS))
    kinds = {field.name: field.dataType.simpleString() for field in found}
    assert kinds == {
        "VARIANT": "double", "a b": "struct<OBJECT:string,x:array<string>>", "a.b": "array<array<string>>", "d": "struct<k:string>",
        "e": "array<string>", "id": "string", "n": "string", "t": "string", "u": "string",
    }


def test_schema_without_objects(spark):
    for rows in ([], ["", "nonsense", "[1, 2]"]):
        assert infer_schema(lines(spark, rows)) == T.StructType()
        assert line_schema(lines(spark, rows)).first().schema is None


def test_inferred_schemas_agree_with_the_reader(spark, tmp_path):
    rng = random.Random(2)
    rows = []
    for i in range(200):
        row = {"id": i, "name": f"n{i}", "tags": [{"text": "a", "at": [1, 2]}] * rng.randrange(3), "ok": rng.random() < 0.5}
        if rng.random() < 0.3:
            row["user"] = {"name": "x", "size": rng.random(), "more": {"deep": [1]}}
        rows.append(json.dumps(row))
    path = tmp_path / "rows.json"
    path.write_text("\n".join(rows))
    theirs = spark.read.json(str(path)).schema
    assert infer_schema(spark.read.text(str(path))).simpleString() == theirs.simpleString()


def test_posts_with_an_inferred_schema_keep_broken_lines_and_digests(spark, tmp_path):
    path = tmp_path / "posts.json"
    path.write_text('{"id": 1, "x": "a"}\n{"x": "a", "id": 1}\n{"id": 2\n\n{"id": 2, "y": {"z": 0.5}}\n')
    posts = read_posts(spark, str(path), schema=None)
    assert posts.columns == ["id", "x", "y", "_corrupt_record", "_line_digest"]
    rows = posts.collect()
    assert sorted(((r.id, r.x, r.y.z if r.y else None, r._corrupt_record) for r in rows), key=repr) == sorted(
        [(1, "a", None, None), (1, "a", None, None), (None, None, None, '{"id": 2'), (2, None, 0.5, None)], key=repr
    )
    assert len({bytes(r._line_digest) for r in rows}) == 3
    assert parse_posts(lines(spark, ["no"]), schema=T.StructType()).columns == ["_corrupt_record", "_line_digest"]


def test_undeclared_fields():
    declared = T._parse_datatype_string("id BIGINT, user STRUCT<name: STRING>, tags ARRAY<STRUCT<text: STRING>>")
    found = T._parse_datatype_string("id BIGINT, new STRING, user STRUCT<name: STRING, zone: STRING>, tags ARRAY<STRUCT<at: INT>>")
    assert undeclared_fields(found, declared) == ["new", "tags.at", "user.zone"]
    assert undeclared_fields(declared, declared) == []


def brute(rows):
    counts, paths = Counter(), set()

    def walk(path, value):
        kind = {dict: "OBJECT", list: "ARRAY", str: "STRING", bool: "BOOLEAN", type(None): None}.get(type(value), "NUMBER")
        paths.add(path)
        counts[path, kind] += kind is not None
        for name, inner in value.items() if kind == "OBJECT" else ():
            walk(name if path == "$" else f"{path}.{name}", inner)
        for inner in value if kind == "ARRAY" else ():
            walk(path + "[]", inner)

    for row in rows:
        try:
            walk("$", json.loads(row))
        except ValueError:
            pass
    found = {(path, kind, n) for (path, kind), n in counts.items() if kind}
    return found | {(path, "NULL", 0) for path in paths if not any(p == path for p, *_ in found)}


def test_path_profile(spark):
    got = {tuple(row) for row in path_profile(lines(spark, ROWS)).collect()}
    assert got == brute(ROWS)
    assert path_profile(lines(spark, [])).collect() == []


def test_global_places(spark):
    rng = random.Random(7)
    rows = [(rng.choice([None, *range(40)]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "n int, i int").repartition(6)
    placed = with_global_place(df, [F.asc("n"), F.asc("i")])
    assert placed.columns == ["n", "i", "place"]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert sorted(map(tuple, placed.collect()), key=lambda r: r[2]) == [(*row, at + 1) for at, row in enumerate(order)]
    assert with_global_place(df.limit(0), [F.asc("n")]).collect() == []


def test_global_places_need_no_single_partition_sort(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("n"), "id")
    plan = with_global_place(df, [F.asc("n"), F.asc("id")])._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan
