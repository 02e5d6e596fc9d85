import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemart.llm import packing, token_counts
from tidemart.llm.tokens import Encoder, default_ranks, default_tokenizer


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_tokenizer())


def check(got, rows, tokenizer, capacity=2048):
    want = sorted((d is None, d or 0, len(i := [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]),
                   np.array(i, "<u4").tobytes()) for d, t in rows)
    docs = {}
    for r in sorted(got, key=lambda r: r.start):
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length > 0
        docs.setdefault(r.doc_id, []).append(r)
    for doc_id, pieces in docs.items():
        texts = [w for w in want if (w[0], w[1]) == (doc_id is None, doc_id or 0)]
        if len(texts) == 1:
            assert b"".join(p.ids for p in pieces) == texts[0][3]
            assert all(p.doc_tokens == texts[0][2] for p in pieces)
    assert sum(r.length for r in got) == sum(w[2] for w in want)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.sequence_tokens))
    for pieces in sequences.values():
        at = 0
        for offset, length, _ in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity and all(p[2] == at for p in pieces)
    return sequences


def test_test_table(stored, tokenizer):
    docs = stored("documents", "/root/testdata/sf0.01")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = packing.pack(docs.repartition(9)).collect()
    sequences = check(got, rows, tokenizer)
    assert sum(r.length for r in got) / (2048 * len(sequences)) > 0.97


def test_pipeline_returns_ids(documents, tokenizer):
    rows = [(None if i % 3 else i, "word " * (i % 37)) for i in range(100)]
    got = corpus_pipeline.packed_sequences(None, documents(rows).repartition(5), "").collect()
    check(got, rows, tokenizer)


def test_checksums_are_of_packed_ids(documents, monkeypatch):
    """Ids that are lost after encoding show in the checksums, without ids in the result as well."""
    staged = packing.staged
    lose = F.transform("pieces", lambda p: p.withField("ids", F.lit(b"")))
    monkeypatch.setattr(packing, "staged", lambda df, name: staged(df.withColumn("pieces", lose), name))
    got = packing.pack(documents([(i, "some words") for i in range(20)]).repartition(5), with_ids=False).collect()
    assert len(got) == 20 and {r.ids_crc32 for r in got} == {0}


def test_many_tasks_are_merged(documents, tokenizer):
    rows = [(i, "word " * (i % 37)) for i in range(600)]
    got = packing.pack(documents(rows).repartition(30), capacity=64, open_windows=4).collect()
    sequences = check(got, rows, tokenizer, 64)
    assert sum(r.length for r in got) / (64 * len(sequences)) > 0.85


def test_edge_cases(documents, tokenizer):
    rows = [(1, None), (2, ""), (None, "x y"), (3, "a" * 50_000), (4, "é　 \n\n w"), (5, "<|endoftext|>a  b")]
    odd = documents(rows).selectExpr("*", "1 as window", "2 as ids", "3 as start")
    check(packing.pack(odd).collect(), rows, tokenizer)
    assert packing.pack(documents([(1, "s"), (1, "s")])).count() == 2
    assert packing.pack(documents([])).count() == 0


def test_encoder_equals_the_tokenizer(stored, tokenizer):
    encoder = Encoder(default_tokenizer(), ranks=default_ranks())
    odd = ["a  b", " a", "a ", "\n \n x", "x  y", "x  y", "it's we'll", "\x1c. a\x1cb", "1 2\t\t3", "  \n", "ﬁ½²", "", "<|endoftext|>a", "　x", "q" * 30_000, " " * 30_000]
    texts = [r.text for r in stored("documents").collect()] + odd
    for text in texts:
        assert encoder.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_token_counts(stored, tokenizer):
    docs = stored("documents", "/root/testdata/sf0.01")
    want = {r.doc_id: len(tokenizer.encode(r.text, add_special_tokens=False).ids) for r in docs.collect()}
    got = token_counts.document_token_counts(docs.repartition(5)).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want and len(got) == len(want)


def test_token_counts_edge_cases(documents):
    rows = [(1, None), (2, ""), (None, "x y"), (3, "<|endoftext|>"), (3, "<|endoftext|>"), (4, "word " * 30_000)]
    odd = documents(rows).selectExpr("*", "1 as file", "2 as ordinal", "3 as bytes")
    got = sorted(((r.doc_id or 0), r.n_tokens > 0) for r in token_counts.document_token_counts(odd).collect())
    assert got == [(0, True), (1, False), (2, False), (3, True), (3, True), (4, True)]
    assert token_counts.document_token_counts(documents([])).count() == 0


@pytest.mark.parametrize("block", [2, 4, 6, 64])
def test_blocks_are_stitched(spark, tmp_path, block):
    files, want = [], set()
    draw = np.random.default_rng(2)
    for name, lengths, tail in (("a", [3, 0, 0, 7, 1], 0), ("b", [], 5), ("c", draw.integers(0, 9, 40).tolist(), 2), ("d", [], 0)):
        ids = np.concatenate([*[np.append(np.full(n, 7), 9) for n in lengths], np.full(tail, 7)]).astype("<u2")
        (tmp_path / name).write_bytes(ids.tobytes())
        files.append((name, ids.nbytes))
        want |= {(name, i, n, True) for i, n in enumerate(lengths)} | ({(name, len(lengths), tail, False)} if tail else set())
    frame = spark.createDataFrame(files, "file string, bytes long")
    got = token_counts.count_tokens(spark, frame, str(tmp_path), end_id=9, block_bytes=block).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
