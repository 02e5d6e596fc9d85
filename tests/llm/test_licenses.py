import random
import re

from tidemart.llm import licenses, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(text):
    return WORD.findall((text or "").translate(LOWER))


def phrase_places(text):
    found = cut(text)
    out = []
    for label, phrase in licenses.BASE_PHRASES:
        want = cut(phrase)
        out += [(i, label) for i in range(len(found)) if found[i : i + len(want)] == want]
    return sorted(out)


def longest_matches(text, template, least):
    """(template's first word, text's first word, words) of runs that no side can be extended by."""
    a, b = cut(text), cut(template)
    out = set()
    for i in range(len(a)):
        for j in range(len(b)):
            if a[i] == b[j] and (i == 0 or j == 0 or a[i - 1] != b[j - 1]):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                    n += 1
                if n >= least:
                    out.add((j, i, n))
    return out


def check(df, rows):
    found = licenses.digests(licenses.license_spans(df)).collect()
    got = sorted((str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found)
    want = []
    for doc_id, text in rows:
        places = phrase_places(text)
        ends = (places[0][0], places[-1][0]) if places else (None, None)
        want.append((str(doc_id), len(cut(text)), len(places), *ends, ",".join(sorted({p for _, p in places}))))
    assert got == sorted(want, key=repr) or sorted(got, key=repr) == sorted(want, key=repr)
    for r in found:
        labels = set(filter(None, r.labels.split(",")))
        assert labels >= set(filter(None, r.base_labels.split(","))) and 0 <= r.score <= 1
        assert bool(labels) == (100 * r.score >= licenses.PERCENT)
    return {r.doc_id: r for r in found}


def test_test_table(stored):
    docs = stored("documents", "/root/testdata/sf0.01")
    check(docs, [(r.doc_id, r.text) for r in docs.collect()])


def test_matches_are_all_longest_ones(monkeypatch):
    draw = random.Random(4)
    for trial in range(150):
        if trial % 2:
            monkeypatch.setattr(words.plain_words, "__defaults__", (draw.choice([1, 5, 9]),))
        else:
            monkeypatch.setattr(words.plain_words, "__defaults__", (1 << 21,))
        templates = [" ".join(draw.choices("abcd", k=draw.randrange(1, 14))) for _ in range(4)]
        phrases = [("one", "a b"), ("two", "b c d"), ("three", "d d d")]
        least = draw.choice([1, 2, 3])
        library = licenses.Library(phrases, [("t", t) for t in templates], least, 2, 75)
        text = " ".join(draw.choices("abcdex", k=draw.randrange(0, 60)))
        n, places, matches = library.scan(text.encode())
        assert n == len(cut(text))
        want = {(t + 3, *m) for t, template in enumerate(templates) for m in longest_matches(text, template, least)}
        assert len(matches) == len(set(matches)) and set(matches) == want
        joined = cut(text)
        want = [(label, i, i + len(cut(p))) for label, p in phrases for i in range(len(joined)) if joined[i : i + len(cut(p))] == cut(p)]
        assert sorted(places) == sorted(want)


def test_chains(documents):
    apache = licenses.TEMPLATES[1][1]
    broken = apache.replace("in compliance with the", "in full accord with our")
    twice = f"{apache} {apache}"
    some = " ".join(apache.split()[:30])
    swapped = " ".join([*apache.split()[45:], "x " * 20, *apache.split()[:40]])
    rows = [(1, f"x y {apache} z"), (2, broken), (3, twice), (4, some), (5, swapped), (6, "Released under the MIT License.")]
    found = {r.doc_id: r.spans for r in licenses.license_spans(documents(rows)).collect()}

    def of(doc_id, template=1):
        return [(s.start, s.end, s.covered) for s in found[doc_id] if s.template == template and s.share >= 0.3]

    n = len(cut(apache))
    assert of(1) == [(2, 2 + n, n)]
    assert len(of(2)) == 1 and of(2)[0][:2] == (0, n + 1) and of(2)[0][2] >= n - 5
    assert of(3) == [(0, n, n), (n, 2 * n, n)]
    assert len(of(4)) == 1 and of(4)[0][2] == len(cut(some))
    # Parts in another order than the template's are two spans.
    assert len(of(5)) == 2
    assert [s.label for s in found[6] if s.share == 1] == ["mit"]


def test_labels(documents):
    rows = [
        (1, "Licensed under CC BY-NC 4.0."), (2, "Licensed under the Apache License, Version 2.0."),
        (3, "This work is licensed under the GNU General Public License, version 3."),
        (4, "Released under the MIT License."), (5, "All rights reserved."), (6, "The licence of poets is free of charge."),
    ]
    found = check(documents(rows), rows)
    assert [found[i].labels for i in range(1, 7)] == ["cc-by,cc-by-nc", "apache-2.0", "gpl", "mit", "reserved", ""]


def test_edge_cases(documents):
    rows = [
        (1, None), (2, ""), (3, "cc\x00by CC-BY cc by"), (4, "ALL rights\nreserved, all RIGHTS reserved"), (None, "cc by"),
        (4, "all rights"), (4, "all rights"), (5, "cc éby cc by é"), (6, "all rights reserved " * 30_000 + "cc by"),
        (7, "x" * 5_000_000 + " general public license"), (8, "general public " * 3 + "license"),
    ]
    df = documents(rows).selectExpr("*", "1 as n_words", "2 as places", "3 as spans")
    check(df, rows)
    assert licenses.digests(licenses.license_spans(documents([]))).count() == 0
