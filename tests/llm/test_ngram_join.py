import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import llm_brute as brute
from tidemart.llm import links, ngram_join
from tidemart.llm.ngram_join import near_duplicates, parity_bitmap
from tidemart.session import staged


def result(df, **options):
    out = near_duplicates(df, **options)
    return sorted((tuple(r) for r in out.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_equals_brute_force_on_the_test_tables(stored, folder):
    docs = stored("documents", folder)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(docs) == sorted(brute.near_duplicates(rows), key=repr)


def test_large_group_of_varied_copies(documents):
    """Links between copies that are not linked to the first or last of their group count too."""
    draw = random.Random(3)
    base = [f"w{draw.randrange(50)}" for _ in range(60)]
    rows = [(0, " ".join(base))]
    for i in range(1, 150):
        copy = list(base)
        for _ in range(draw.randrange(1, 4)):
            copy[draw.randrange(60)] = f"x{draw.randrange(1000)}"
        rows.append((i, " ".join(copy)))
    draw.shuffle(rows)
    got = result(documents(rows))
    assert got == sorted(brute.near_duplicates(rows), key=repr)
    assert len({c for _, _, c in got}) < 100


@pytest.mark.parametrize("size", [1, 40, 400, 5000])
def test_bitmaps_differ_no_more_than_their_sets(size):
    draw = np.random.default_rng(size)
    one = np.unique(draw.integers(0, 2**63, size, np.uint64))
    for changed in (0, 1, size // 10, size // 2):
        other = np.unique(np.concatenate((one[changed:], draw.integers(0, 2**63, changed // 2, np.uint64))))
        bits = int(np.bitwise_count((parity_bitmap(one) ^ parity_bitmap(other)).view(np.uint64)).sum())
        assert bits <= len(np.setxor1d(one, other))


def test_chain_of_links(documents):
    long = [f"t{i}" for i in range(400)]
    rows = [(100 - k, " ".join(long[8 * k : 8 * k + 200])) for k in range(20)]
    assert {c for _, _, c in result(documents(rows))} == {81}


def test_edge_cases(documents):
    rows = [
        (5, None), (6, ""), (7, " \t\n "), (8, "a b"), (9, "A  B"), (10, "a b c"), (None, "a b"),
        (None, None), (11, "x " * 30_000), (11, "x " * 30_000), (12, "  　 wide"), (13, "É é É é É é"),
    ]
    got = result(documents(rows))
    assert got == sorted(brute.near_duplicates(rows), key=repr) or [
        (a, b, a if b == 0 else c) for a, b, c in sorted(brute.near_duplicates(rows), key=repr)
    ] == got
    assert (None, 1, 8) in got and (6, 0, 6) in got


def test_empty_table_and_clashing_columns(documents, spark):
    assert result(documents([])) == []
    odd = documents([(1, "a b c d e f"), (2, "a b c d e f")]).selectExpr(
        "*", "1 as node", "'k' as key", "2 as n", "'c' as component", "3 as row_key"
    )
    assert result(odd) == [(1, 2, 1), (2, 2, 1)]


def test_equal_fingerprints_are_chosen_anew(stored, monkeypatch):
    docs = stored("documents")
    want = sorted(map(tuple, ngram_join.near_duplicates(docs).collect()), key=repr)
    answers = iter([True, False])
    monkeypatch.setattr(ngram_join, "collide", lambda nodes: next(answers))
    assert sorted(map(tuple, ngram_join.near_duplicates(docs).collect()), key=repr) == want
    assert next(answers, None) is None


def test_a_pair_is_verified_once(spark, documents, monkeypatch):
    draw = random.Random(6)
    common = [f"c{i}" for i in range(40)]
    rows = [(i, " ".join([*common, *[f"u{draw.randrange(10**9)}" for _ in range(draw.randrange(8, 16))]])) for i in range(300)]
    tested = []
    real = links.linked_components

    def counted(shared, verify, *rest):
        def once(pairs):
            tested.extend(map(tuple, pairs.collect()))
            return verify(pairs)

        return real(shared, once, *rest)

    monkeypatch.setattr(ngram_join, "linked_components", counted)
    got = ngram_join.near_duplicates(documents(rows)).collect()
    assert len(tested) == len(set(tested))
    assert sorted((r.doc_id, r.component_id) for r in got) == sorted((d, c) for d, _, c in brute.near_duplicates(rows))


def test_digests_refuse_pairs_of_small_keys(spark):
    """Nodes of a key that no digest allows to link are tested against the ends of the key only."""
    nodes = [(7, n, 0) for n in range(12)]
    shared = staged(links.with_hubs(spark.createDataFrame(nodes, "key long, node long, info long")), "shared")
    marks = spark.createDataFrame([(n, n) for _, n, _ in nodes], "node long, mark long")
    tested = []

    def verify(pairs):
        tested.extend((r.a, r.b) for r in pairs.collect())
        return pairs.where("false")

    allowed = lambda one, other: one["mark"] == other["mark"]
    links.linked_components(shared, verify, lambda one, other: F.lit(True), "small", marks, allowed)
    assert set(tested) == {(0, n) for n in range(1, 12)} | {(n, 11) for n in range(11)}


def watch(monkeypatch, module):
    """Rows of the tables that ``module`` writes, by name, and the plans behind them."""
    rows, plans, real = {}, {}, module.staged

    def watched(df, name):
        out = real(df, name)
        rows[name] = rows.get(name, 0) + out.count()
        plans[name] = plans.get(name, "") + df._jdf.queryExecution().optimizedPlan().toString()
        return out

    monkeypatch.setattr(module, "staged", watched)
    return rows, plans


def test_keys_without_untested_pairs_do_not_travel(spark, monkeypatch):
    nodes = [(k, 3 * k + i, 0) for k in range(20) for i in range(3)]
    shared = staged(links.with_hubs(spark.createDataFrame(nodes, "key long, node long, info long")), "shared")
    rows, _ = watch(monkeypatch, links)
    links.linked_components(shared, lambda pairs: pairs.where("false"), lambda one, other: F.lit(True), "small")
    assert rows.pop("small-stars") == 60
    assert not any(rows.values()), rows


def test_pairs_of_many_keys_become_one_before_tested_ones_go(spark, monkeypatch):
    """Nodes that share thirty keys: no join multiplies their pairs by the keys again."""
    nodes = [(k, n, 0) for k in range(30) for n in range(12)]
    shared = staged(links.with_hubs(spark.createDataFrame(nodes, "key long, node long, info long")), "shared")
    rows, plans = watch(monkeypatch, links)
    found = links.linked_components(
        shared, lambda pairs: pairs.where("a % 3 = b % 3"), lambda one, other: F.lit(True), "many"
    )
    assert {(r.node, r.component) for r in found.collect()} == {(n, n % 3) for n in range(12)}
    assert rows["many-stars"] + rows["many-across"] <= 66 and "LeftAnti" not in plans["many-across"]


def test_texts_come_only_to_pairs_that_may_link(documents, monkeypatch):
    """Pairs that share rare shingles, but by their bitmaps too few of them."""
    draw = random.Random(8)
    some = lambda n: [f"w{draw.randrange(10**9)}" for _ in range(n)]
    texts = []
    for _ in range(20):
        base = some(50)
        texts += [" ".join(base + some(10)) for _ in range(2)]
    rows, _ = watch(monkeypatch, ngram_join)
    got = result(documents(list(enumerate(texts))))
    assert rows["ngram-wanted"] == 40 and {c for _, _, c in got} == set(range(40))
    assert rows.get("ngram-sets", 0) + rows.get("ngram-texts", 0) == 0
