import zlib

import numpy as np
import pytest

from tidemart.llm import sharding


@pytest.mark.parametrize("n", [1, 2, 3, 40, 1000, 4097])
def test_permutation(n):
    p = sharding.Permutation(n, seed=5)
    out = p.forward(np.arange(n))
    assert sorted(out) == list(range(n))
    assert list(p.inverse(out)) == list(range(n))
    shard, slot = sharding.locate(np.arange(n), n, 7, seed=5)
    assert list(sharding.row_at(shard, slot, n, 7, seed=5)) == list(range(n))


def check(got, rows, shards=40):
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == sorted(
        (d is None, d or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows
    )
    slots = {}
    for r in got:
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < shards
        slots.setdefault(r.shard, []).append(r.slot)
    counts = [len(slots.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_test_table_and_repartitioning(stored):
    docs = stored("documents", "/root/testdata/sf0.01")
    got = sharding.shard_documents(docs).collect()
    check(got, [(r.doc_id, r.text) for r in docs.collect()])
    again = sharding.shard_documents(docs.repartition(13)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    for r in got[:20]:
        shard, slot = sharding.locate(r.row_number, len(got), 40)
        assert (r.shard, r.slot) == (shard[0], slot[0])


def test_edge_cases(documents):
    rows = [(None, None), (None, "x"), (1, ""), (1, "é" * 100_000)] + [(7, "same")] * 2500
    check(sharding.shard_documents(documents(rows)).collect(), rows)
    assert sharding.shard_documents(documents([])).count() == 0
    odd = documents([(1, "a")]).selectExpr("*", "1 as shard", "2 as slot", "3 as size")
    check(sharding.shard_documents(odd).collect(), [(1, "a")])


def test_written_shards(documents, spark, tmp_path):
    rows = [(i, f"t{i}") for i in range(100)]
    sharding.write_shards(sharding.shard_rows(documents(rows), ["doc_id"], 3), str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(r.n for r in back.groupBy("shard").agg({"*": "count"}).toDF("shard", "n").collect()) == [33, 33, 34]
    with pytest.raises(ValueError):
        sharding.shard_rows(back, ["doc_id"], 3)
