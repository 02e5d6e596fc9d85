from collections import Counter

import llm_brute as brute
from tidemart.llm import quality


def measured(text):
    text = text or ""
    words = brute.words(text)
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if brute.words(line)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
    }


def check(df, rows):
    got = sorted((r.asDict() for r in quality.judge(df).collect()), key=repr)
    want = []
    for doc_id, text in rows:
        m = measured(text)
        bad = m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]
        want.append({"doc_id": doc_id, **m, "base_failed": bad})
    key = lambda r: repr(sorted((k, r[k]) for k in want[0])) if want else ""
    assert sorted(map(key, got)) == sorted(map(key, want))
    assert not any(r["kept"] and r["base_failed"] for r in got)
    return got


def test_test_table(stored):
    docs = stored("documents", "/root/testdata/sf0.01")
    check(docs, [(r.doc_id, r.text) for r in docs.collect()])


def test_edge_cases(documents):
    rows = [
        (1, None), (2, ""), (3, "a b c a b c"), (4, "x x x x"), (5, "l1\nl1\n\n \nl2\r\nl1"), (None, "é　w" * 20_000),
        (6, "#*$ % &|<>" * 30), (6, "#*$ % &|<>" * 30), (7, "word " * 100_000), (8, "a\x0bb\x0cc\x1cd e"),
    ]
    check(documents(rows), rows)
    assert quality.judge(documents([])).count() == 0


def test_passing_keeps_all_columns(documents):
    good = " ".join(f"word{i}" for i in range(60))
    df = documents([(1, good), (2, "short"), (1, good)]).selectExpr("*", "7 as failed", "8 as n_words", "9 as kept")
    out = quality.passing(df)
    assert out.columns == df.columns and [r.doc_id for r in out.collect()] == [1, 1]


def test_ablations(documents):
    rows = [(1, "short"), (2, "x " * 100), (3, "#&| w " * 40), (4, " ".join(f"w{i}" for i in range(80)))]
    book = quality.ledger(documents(rows))
    failed = [r.failed for r in book.collect()]
    got = {r.rule: (r.failed_documents, r.rejected_by_it_alone) for r in quality.ablations(book, "v1").collect()}
    for i, rule in enumerate(quality.RULES):
        assert got[rule] == (sum(bool(f >> i & 1) for f in failed), sum(f == 1 << i for f in failed))
