from collections import defaultdict

import pytest

import llm_brute as brute
from tidemart.llm import mixing


def level_targets(sizes, share=1.5, most=2.0):
    """Reshare the excess until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    left, fixed, open_ = share * sum(sizes.values()), {}, set(order)
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if most * sizes[s] <= left * weight[s] / total}
        if not over:
            fixed |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            fixed[s] = most * sizes[s]
        left -= sum(fixed[s] for s in over)
        open_ -= over
    return fixed


def check(df, rows):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[2]] += len(brute.words(r[1]))
    want = level_targets(sizes)
    taken, got = defaultdict(int), mixing.mix(df).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for source, target in want.items():
        assert abs(taken[source] - target) < 1 + 1e-6
    return got


def test_test_table(stored):
    docs = stored("documents", "/root/testdata/sf0.01")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    got = check(docs, rows)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_edge_cases(documents):
    rows = [
        (1, "a " * 50_000, "big"), (2, None, "big"), (3, "", "empty"), (4, None, None), (5, "x y z", None),
        (6, "one two", "é"), (6, "one two", "é"), (7, " \t ", "only blank"),
    ]
    check(documents(rows), rows)


@pytest.mark.parametrize("text", ["w", "a b c", "a b c d"])
def test_equal_rows_at_the_boundary_meet_the_target(documents, text):
    rows = [(1, text, "hot")] * 1000 + [(i, "a b c d e f g h", f"s{i}") for i in range(2, 9)]
    for some in (rows, rows[:1000], [(1, text, None)] * 1000):
        check(documents(some).repartition(7), some)
        size = len(text.split())
        copies = mixing.mixed_documents(documents(some)).where("doc_id = 1").count()
        sizes = defaultdict(int)
        for r in some:
            sizes[r[2]] += len(r[1].split())
        assert abs(copies * size - level_targets(sizes)[some[0][2]]) <= size / 2


def test_empty_and_clashing(documents, spark):
    assert mixing.mix(documents([])).count() == 0
    rows = [(1, "a b", "s"), (2, "c d", "t")]
    odd = documents(rows).selectExpr("*", "1 as target", "2 as taken", "3 as size", "4 as source_size", "5 as _row", "6 as _size")
    assert mixing.mix(odd).count() == 2
    assert mixing.mixed_documents(odd).columns == odd.columns


def test_whole_documents(stored):
    docs = stored("documents")
    bounds = {r.doc_id: r.taken / r.size for r in mixing.mix(docs).collect() if r.size}
    copies = defaultdict(int)
    for r in mixing.mixed_documents(docs).collect():
        copies[r.doc_id] += 1
    for doc_id, times in bounds.items():
        assert abs(copies[doc_id] - times) <= 0.5 + 1e-9
