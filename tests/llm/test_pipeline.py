"""Every stage of the pipeline against a plain re-statement on its own input, and all SQL statements."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as spark_entry
import llm_brute as brute
import corpus_pipeline
from oracle_check import connect, mismatch
from test_line_dedup import expected
from tidemart.llm import quality
from tidemart.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of every stage."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, FOLDER).coalesce(1).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = (docs.collect(), after.collect(), docs.columns, after.columns)
        docs = after
    return out


def test_stages_keep_the_columns(stages):
    for name, (_, _, before, after) in stages.items():
        assert name == "packing" or before == after


def test_quality(stages, stored):
    before, after, *_ = stages["quality_rules"]
    kept = {r.doc_id for r in quality.judge(stored("documents")).collect() if r.kept}
    assert sorted(map(tuple, after)) == sorted(tuple(r) for r in before if r.doc_id in kept)
    assert len(after) < len(before)


def test_line_dedup(stages):
    before, after, *_ = stages["line_dedup"]
    texts = expected([r.text for r in before])
    want = {r.doc_id: t for r, t in zip(before, texts) if t == r.text or brute.words(t)}
    assert {r.doc_id: r.text for r in after} == want
    assert all(r.n_chars == len(r.text) for r in after)


def test_near_duplicates(stages):
    before, after, *_ = stages["near_duplicates"]
    rows = [(r.doc_id, r.text) for r in before]
    want = {d for d, _, c in brute.near_duplicates(rows) if d == c}
    assert sorted(r.doc_id for r in after) == sorted(want)


def test_one_per_component_of_repeated_rows(documents):
    from tidemart.llm.ngram_join import one_per_component

    rows = [(2, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (None, "x y z"), (None, "x y z"), (3, None)]
    got = one_per_component(documents(rows).coalesce(1)).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter([(2, "a b c d e f"), (None, "x y z"), (3, None)])


def test_mix_and_packing(stages):
    before, after, *_ = stages["source_mix"]
    times = Counter(r.doc_id for r in after)
    assert set(times) <= {r.doc_id for r in before} and max(times.values()) <= 2
    words = lambda rows: sum(len(brute.words(r.text)) for r in rows)
    assert abs(words(after) / words(before) - 1.5) < 0.1
    before, after, *_ = stages["packing"]
    assert sum(r.length for r in after if r.start == 0) > 0
    assert {r.doc_id for r in after} == {r.doc_id for r in before}
    assert sum(r.start == 0 for r in after) == len(before)


ODD = [
    (1, "the words of a good line " * 12, "a"), (1, "the words of a good line " * 12, "a"), (None, None, None), (2, "", "b"),
    (3, " ".join(f"word{i}" for i in range(80)) + "\nthe same closing line for everyone here", "b"),
    (4, " ".join(f"term{i}" for i in range(80)) + "\nthe same closing line for everyone here", None),
    (None, " ".join(f"name{i}" for i in range(80)), "c"),
]


@pytest.mark.parametrize("rows", [[], ODD, ODD * 3])
def test_stages_on_odd_rows_and_clashing_columns(spark, documents, tmp_path, rows):
    names = ("_row", "_removed", "_all", "_doc", "doc", "removed", "node", "taken", "_size", "_hash", "failed", "kept")
    docs = documents(rows).selectExpr("*", *[f"{i} as {n}" for i, n in enumerate(names)])
    before = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name == "packing":
            break
        assert docs.columns == before, name
        found = docs.collect()
        assert all(r[n] == i for r in found for i, n in enumerate(names))
        assert bool(found) == bool(rows)
    if rows:
        assert sum(bool(r.text and "closing line" in r.text) for r in found) <= 2
        assert {r.doc_id for r in found} == {3, 4, None}


def test_run_is_registered(spark):
    assert spark_entry.queries()["pipeline"](spark, FOLDER).columns[0] == "doc_id"
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", list(ORACLES))
@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_query_matches_oracle(spark, name, folder):
    assert mismatch(spark, connect(folder), name, folder) is None


def test_oracle_of_quality_on_odd_texts(spark, documents, tmp_path):
    rows = [(1, None), (2, ""), (3, "a b c a b c\na b c a b c"), (3, "# $ x"), (4, "\n \n\x0b"), (5, "é　w " * 60)]
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert mismatch(spark, con, "op10_quality_rules", str(tmp_path)) is None
