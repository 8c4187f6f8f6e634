"""The registered queries over the smallest tables, with SQL where there is some; the pipeline stage by stage."""

import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from daybook.llm.queries import ORACLE_SQL, QUERIES
from test_operators import SPACES, plain_components, plain_fingerprint

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in SF.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, str(SF))
    expected = duck.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert Counter(tuple(r) for r in df.collect()) == Counter(expected)


@pytest.mark.parametrize("name", QUERIES.keys() - ORACLE_SQL.keys())
def test_query_covers_every_document(spark, duck, name):
    found = {r[0] for r in QUERIES[name](spark, str(SF)).select("doc_id").collect()}
    assert found == {i for (i,) in duck.execute("SELECT doc_id FROM documents").fetchall()}


@pytest.mark.parametrize(("name", "label"), [("op6_toxicity", "toxic"), ("op8_quality", "quality")])
def test_labels_are_learnt(spark, name, label):
    """On rows that nothing was learnt from, and against always saying the more frequent label."""
    sf = SF.parent / "sf0.1"
    labels = dict(duckdb.sql(f"SELECT doc_id, {label} FROM '{sf}/labels.parquet'").fetchall())
    rows = [r for r in QUERIES[name](spark, str(sf)).where("held_out").collect() if r.doc_id in labels]
    assert rows and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    truth = np.array([labels[r.doc_id] for r in rows])
    found = np.array([r.predicted for r in rows])
    for kind in (0, 1):
        assert np.mean(found[truth == kind] == kind) > 0.85
    assert np.mean(found == truth) > 0.97 > max(truth.mean(), 1 - truth.mean())


def test_pipeline(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact dedup", "near-dedup", "mixing", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(SF)).persist()
        kept[name] = docs.collect()
        if name != "packing":
            assert docs.columns == spark.read.parquet(f"{SF}/documents.parquet").columns
    first = {}
    for r in sorted(kept["quality"], key=lambda r: r.doc_id):
        first.setdefault(SPACES.sub(" ", r.text), r.doc_id)
    assert sorted(r.doc_id for r in kept["exact dedup"]) == sorted(first.values())
    ordered = sorted(kept["exact dedup"], key=lambda r: r.doc_id)
    roots = plain_components([plain_fingerprint(r.text) for r in ordered], 4)
    assert sorted(r.doc_id for r in kept["near-dedup"]) == sorted({ordered[i].doc_id for i in roots})
    words = lambda rows: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in rows)
    assert words(kept["mixing"]) == pytest.approx(1.5 * words(kept["near-dedup"]), rel=0.05)
    assert Counter(r.doc_id for r in kept["packing"] if r.piece == 0) == Counter(r.doc_id for r in kept["mixing"])


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, str(SF)).columns[0] == "doc_id"



LABELS = "doc_id long, quality int, toxic int, text string, label string"
ODD_LABELS = [(i, i % 2, i % 3 % 2, "t", "l") for i in range(60)]
ODD_LABELS += [(60, None, None, None, None), (None, 1, 1, "t", "l"), (3, 0, 1, "t", "l"), (3, 1, 0, "t", "l"), (4, 0, 1, "t", "l")]


@pytest.mark.parametrize(("docs", "labels"), [("odd_docs", ODD_LABELS), ("odd_docs", []), ("no_docs", [])])
def test_stages_take_odd_and_empty_tables(spark, request, tmp_path, docs, labels):
    spark.createDataFrame(labels, LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    given = request.getfixturevalue(docs)
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, given, str(tmp_path))
        if name != "packing":
            assert found.schema == given.schema
        assert docs == "odd_docs" or found.count() == 0
        found.collect()


CASES = [(n, *case) for n in QUERIES if n != "op2_url_lists" for case in (("odd_docs", ODD_LABELS), ("no_docs", []))]
CASES += [(n, "odd_docs", []) for n in ("op6_toxicity", "op8_quality")]


@pytest.mark.parametrize(("name", "docs", "labels"), CASES)
def test_queries_take_odd_and_empty_tables(spark, request, tmp_path, name, docs, labels):
    given = request.getfixturevalue(docs)
    spark.createDataFrame(labels, LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    given.write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES[name](spark, str(tmp_path))
    ids = Counter(r.doc_id for r in found.select("doc_id").collect())
    expected = Counter(r.doc_id for r in given.select("doc_id").collect())
    assert ids == expected if name not in ("op7_pack", "op11_bin_slack") else ids.keys() == expected.keys()


def test_url_lists_take_odd_and_no_pages(spark, tmp_path):
    schema = "page_id long, url string, html string, host string, rule string, month string"
    odd = [(None, "http://a.b.c/x", None, "h", "r", "m"), (1, None, "", "h", "r", "m"), (2, "", "", "h", "r", "m")]
    odd += [(3, "no url", "", "h", "r", "m"), (4, "http://x/", "", "h", "r", "m"), (4, "http://x/", "", "h", "r", "m")]
    for n, rows in enumerate((odd, [])):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{n}/pages.parquet"))
        found = QUERIES["op2_url_lists"](spark, str(tmp_path / str(n))).collect()
        assert Counter(r.page_id for r in found) == Counter(r[0] for r in rows)
        assert all(r.listed == (r.n_active > 0) for r in found)
