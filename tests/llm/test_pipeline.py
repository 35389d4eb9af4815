"""The numbered queries against SQL, and the pipeline stage by stage against brute force."""

import os
from collections import Counter

import pytest

import corpus_pipeline
from plazalens.llm import mixing
from plazalens.llm.common import kept
from plazalens.llm.oracle import ORACLE
from plazalens.llm.queries import QUERIES
from tests.llm.test_dedup import near_rows, normalised

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {os.path.splitext(file)[0]} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    got = [tuple(row) for row in result.select(*columns).collect()]
    answer = duck.execute(ORACLE[name])
    names = [column[0] for column in answer.description]
    assert sorted(names) == columns
    expected = [tuple(row[names.index(c)] for c in columns) for row in answer.fetchall()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected)) and got


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    names = list(stages)
    rows = docs.collect()

    docs = kept(stages[names[0]](spark, docs, SF_DIR), "stage")
    assert docs.columns == columns
    kept_rows = docs.collect()
    assert sorted(r.doc_id for r in kept_rows) == sorted(r.doc_id for r in rows if any(c.isalpha() for c in r.text))

    docs = kept(stages[names[1]](spark, docs, SF_DIR), "stage")
    least = {}
    for row in kept_rows:
        least[normalised(row.text)] = min(row.doc_id, least.get(normalised(row.text), row.doc_id))
    assert docs.columns == columns
    kept_rows = docs.collect()
    assert sorted(r.doc_id for r in kept_rows) == sorted(least.values())

    docs = kept(stages[names[2]](spark, docs, SF_DIR), "stage")
    expected = [row[0] for row in near_rows([(r.doc_id, r.text) for r in kept_rows], 5) if row[3]]
    assert docs.columns == columns
    assert sorted(r.doc_id for r in docs.collect()) == sorted(expected)

    times = {r.doc_id: r.taken // r.size + (2 * (r.taken % r.size) >= r.size) for r in mixing.mix(docs).collect() if r.taken}
    texts = {r.doc_id: r.text for r in docs.collect()}
    docs = kept(stages[names[3]](spark, docs, SF_DIR), "stage")
    assert docs.columns == columns
    came = Counter()
    for row in docs.collect():
        came[row.doc_id] += 1
        assert row.text == texts[row.doc_id] and row.n_chars == len(row.text)
    assert came == {doc: n for doc, n in times.items() if n}

    pieces = stages[names[4]](spark, docs, SF_DIR).collect()
    sizes = Counter()
    for piece in pieces:
        sizes[piece.sequence_id] += piece.length
    assert sum(size != 2048 for size in sizes.values()) <= 1
    whole = corpus_pipeline.run(spark, SF_DIR).collect()
    key = lambda p: (p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens)
    assert sum(p.length for p in whole) == sum(p.length for p in pieces)
    assert {key(p)[0] for p in whole} == {key(p)[0] for p in pieces}
