import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest

from tidemart.llm import importance, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(text):
    return WORD.findall((text or "").translate(LOWER))


def runs(text, order):
    found = cut(text)
    return [" ".join(found[i : i + k]) for k in range(1, order + 1) for i in range(len(found) - k + 1)]


def brute(rows, target, order, buckets=10_000, least=20, percent=10):
    places = lambda text: [crc32(f.encode()) % buckets for f in runs(text, order)]
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(places(text))
    for text in target:
        t.update(places(text))
    all_s, all_t = s.total() + buckets, t.total() + buckets
    gain = lambda b: math.floor(1000 * math.log(float((t[b] + 1) * all_s) / float((s[b] + 1) * all_t)))
    out = []
    for at, (doc_id, text) in enumerate(rows):
        weight = sum(map(gain, places(text)))
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append([doc_id, len(runs(text, order)), weight, score, None, len(cut(text))])
    fit = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(fit[: percent * len(fit) // 100]):
        row[4] = place + 1
    return sorted(map(tuple, out), key=repr)


def check(spark, df, rows, target, order=1, **options):
    texts = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resampled(df, texts, order=order, **options).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, target, order, **{"least": options.get("least_words", 20), **{k: v for k, v in options.items() if k != "least_words"}})
    return got


def test_test_table_with_longer_runs(spark, stored):
    docs, target = stored("documents"), stored("benchmark")
    rows, texts = [(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()]
    for order in (1, 3):
        check(spark, docs.repartition(3), rows, texts, order)


def test_edge_cases(spark, documents):
    long = "Wort wört " * 40_000
    rows = [(1, None), (2, ""), (3, "a b c"), (None, "w " * 30), (None, "w " * 30), (5, "x\x00y\x7fz é" * 20), (6, long)]
    rows += [(7, "same words " * 15)] * 25 + [(8, "same words " * 15)] * 5
    df = documents(rows).selectExpr("*", "1 as score", "2 as n_words", "3 as _row", "4 as rank")
    for order in (1, 2):
        check(spark, df, rows, ["same words here", None, ""], order, percent=50)
    check(spark, df, rows, [], 1, buckets=7, least_words=0, percent=100)
    empty = importance.resampled(documents([]), spark.createDataFrame([], "text string"))
    assert empty.count() == 0


def test_long_texts_are_read_in_blocks(monkeypatch):
    draw = random.Random(3)
    for _ in range(300):
        text = "".join(draw.choices("aB9 é-\n\x7fΣ", k=draw.randrange(60)))
        monkeypatch.setattr(words.plain_words, "__defaults__", (draw.choice([1, 4, 9, 1 << 21]),))
        for order in (1, 2, 3):
            found = sorted(c for _, part in importance._features(text.encode(), order) for c in part)
            assert found == sorted(crc32(f.encode()) for f in runs(text, order))


def test_task_sums_do_not_depend_on_what_is_held(spark, stored, monkeypatch):
    texts = stored("benchmark").select("text")
    want = {tuple(r) for r in importance.bucket_counts(texts, 2).collect()}
    monkeypatch.setattr(importance, "HELD", 5)
    assert {tuple(r) for r in importance.bucket_counts(texts, 2).collect()} == want


@pytest.mark.parametrize("names", [(), ("_row", "_all", "rank", "n_words")])
def test_drawn_documents_keep_all_columns(spark, stored, names):
    docs, target = stored("documents"), stored("benchmark")
    df = docs.selectExpr("*", *[f"doc_id + {i} as {n}" for i, n in enumerate(names)])
    drawn = importance.drawn_documents(df, target)
    assert drawn.columns == df.columns
    want = {r.doc_id for r in importance.resampled(docs, target).where("rank is not null").collect()}
    rows = drawn.collect()
    assert {r.doc_id for r in rows} == want and len(rows) == len(want)
    for i, n in enumerate(names):
        assert all(r[n] == r.doc_id + i for r in rows)
