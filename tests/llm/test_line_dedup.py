import random
from pathlib import Path

import llm_brute as brute
from pyspark.sql import functions as F
from tidemart.llm import line_dedup, links, ngram_join

K = line_dedup.CHARACTERS


def grams(line):
    return {line[i : i + K] for i in range(len(line) - K + 1)}


def expected(texts):
    """Texts with the first line of every class of equal or similar lines kept."""
    lines = list(dict.fromkeys(x for t in texts for x in (t or "").split("\n") if brute.words(x)))
    sets = [grams(x) for x in lines]
    holders = {}
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    pairs = {(a, b) for h in holders.values() for j, a in enumerate(h) for b in h[j + 1 :]}
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    keep = {lines[c] for c in brute.classes(len(lines), links)}
    out, seen = [], set()
    for text in texts:
        if text is None:
            out.append(None)
            continue
        left = []
        for line in text.split("\n"):
            if not brute.words(line) or (line in keep and line not in seen):
                left.append(line)
            seen.add(line)
        out.append("\n".join(left))
    return out


def check(df, rows):
    got = {r.doc_id: r for r in line_dedup.deduplicated(df).collect()}
    assert len(got) == len(rows)
    for (doc_id, text), want in zip(rows, expected([t for _, t in rows])):
        assert got[doc_id].text == want, doc_id
        assert got[doc_id].n_lines == (0 if text is None else text.count("\n") + 1)


def test_test_table(stored):
    docs = stored("documents").coalesce(1)
    check(docs, [(r.doc_id, r.text) for r in docs.collect()])


def test_near_lines(documents):
    draw = random.Random(1)
    base = ["".join(draw.choice("abcdefgh ") for _ in range(400)) for _ in range(5)]
    rows = []
    for i in range(60):
        line = list(base[i % 5])
        for _ in range(draw.randrange(3)):
            line[draw.randrange(400)] = "#"
        rows.append((i, "".join(line) + f"\nown line {i} {draw.random()}"))
    check(documents(rows).coalesce(1), rows)


def test_edge_cases(documents):
    rows = [
        (1, None), (2, ""), (3, "\n\n"), (4, "short\nshort"), (5, "short\n \t\nthe same longer line"),
        (6, "the same longer line\nshort"), (7, "é" * 60_000), (8, "é" * 60_000 + "\nshorter"), (9, "😀" * 40),
    ]
    odd = documents(rows).selectExpr("*", "1 as node", "2 as line", "3 as key", "4 as first", "5 as _row", "6 as _all", "7 as `a.b`").coalesce(1)
    check(odd, rows)
    assert line_dedup.deduplicated(documents([])).count() == 0
    twice = line_dedup.deduplicated(documents([(None, "a long enough line")] * 3)).collect()
    assert sorted(r.text for r in twice) == ["", "", "a long enough line"]


def pairs_found(documents, pairs):
    """For pairs of lines that stand next to each other, whether the second was found."""
    rows = [(i, line) for i, line in enumerate(x for pair in pairs for x in pair)]
    left = {r.doc_id: r.n_removed for r in line_dedup.deduplicated(documents(rows).coalesce(1)).collect()}
    return [left[2 * i + 1] == 1 for i in range(len(pairs))]


def test_planted_edits_on_short_lines(documents):
    """A changed character inside a line is found from 49 characters, a changed word of five letters from 85."""
    draw = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    plain = lambda n: "".join(draw.choice(letters) for _ in range(n))
    kinds, pairs = [], []
    for length in (40, 48, 49, 60, 80, 84, 85, 88, 100, 130):
        for width in (1, 5):
            for _ in range(30):
                line, at = plain(length), draw.randrange(length // 2 - 8, length // 2)
                new = "".join(draw.choice("0123456789") for _ in range(width))
                kinds.append((width, length))
                pairs.append((line, line[:at] + new + line[at + width :]))
    found = {}
    for kind, got in zip(kinds, pairs_found(documents, pairs)):
        found[kind] = found.get(kind, 0) + got
    for (width, length), n in found.items():
        assert n >= 28 if length >= (49 if width == 1 else 85) else n == 0, (width, length, n)


def test_recall_near_the_similarity(spark):
    """Bands of pairs of a similarity of 0.80 to 0.85, of short and long lines."""
    draw = random.Random(7)
    lines, n = [], 0
    while n < 4000:
        length = draw.choice((60, 120, 240))
        one = [chr(draw.randrange(97, 123)) for _ in range(length)]
        other = list(one)
        for _ in range(draw.randrange(1, length // 40 + 1)):
            other[draw.randrange(length)] = "#"
        a, b = grams("".join(one)), grams("".join(other))
        if 80 * len(a | b) <= 100 * len(a & b) < 85 * len(a | b):
            lines += [(2 * n, "".join(one)), (2 * n + 1, "".join(other))]
            n += 1
    postings = line_dedup.banded(
        spark.createDataFrame(lines, "node long, line string"), K, line_dedup.BANDS, line_dedup.ROWS, 11
    )
    found = postings.selectExpr("key", "node div 2 as pair", "node % 2 as side").distinct()
    met = found.groupBy("key", "pair").count().where("count = 2").select("pair").distinct().count()
    assert met >= 0.998 * n, met / n


def test_partitions_that_move_between_scans(spark, documents, tmp_path, monkeypatch):
    """The files are read as one partition and as sixteen, in turn after each written table."""
    rows = [(i, f"line {i} of many words {i * 7919}\nsaid by everyone alike\nend {i * i}") for i in range(64)]
    documents(rows).repartition(16).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    scans = [1, 16]
    key = "spark.sql.files.minPartitionNum"

    def moving(staged):
        def run(*args):
            out = staged(*args)
            scans.reverse()
            spark.conf.set(key, scans[0])
            return out

        return run

    for module in (line_dedup, ngram_join):
        monkeypatch.setattr(module, "staged", moving(module.staged))
    spark.conf.set(key, scans[0])
    try:
        got = {r.doc_id: r.text.split("\n") for r in line_dedup.deduplicated(docs).collect()}
        scans.sort()
        spark.conf.set(key, scans[0])
        alone = ngram_join.one_per_component(docs).select("doc_id").collect()
    finally:
        spark.conf.unset(key)
    own = {i: text.split("\n") for i, text in rows}
    assert all([x for x in got[i] if x in own[i]] == got[i] for i in own)
    assert sum("said by everyone alike" in lines for lines in got.values()) == 1
    kept = [x for lines in got.values() for x in lines]
    assert len(set(kept)) == len(kept) and {r.doc_id for r in alone} == set(own)


def test_boilerplate_lines_make_few_pairs(documents, monkeypatch):
    """Lines that share most of their text but do not link: what is compared exactly grows with the lines."""
    draw = random.Random(9)
    common = "".join(draw.choice("abcdefghij") for _ in range(60))
    seen = []
    verify = line_dedup.similar

    def counting(pairs, *rest):
        seen[-1] += pairs.count()
        return verify(pairs, *rest)

    monkeypatch.setattr(line_dedup, "similar", counting)
    for n in (500, 1000, 2000):
        rows = [(i, common + "".join(draw.choice("klmnopqrstuvwxyz") for _ in range(25))) for i in range(n)]
        seen.append(0)
        assert {r.n_removed for r in line_dedup.deduplicated(documents(rows)).collect()} == {0}
    assert seen[2] <= 3 * seen[1] + 1000, seen


def test_all_columns_come_back(documents):
    rows = [(1, "one line of text\nanother line of text"), (2, "one line of text\nown words here"), (3, None)]
    odd = documents(rows).selectExpr("*", "doc_id + 5 as _row", "doc_id + 6 as _removed", "doc_id + 7 as _all", "doc_id as doc").coalesce(1)
    out = line_dedup.without_repeats(odd)
    assert out.columns == odd.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[2].text == "own words here" and got[3].text is None
    assert all((r._row, r._removed, r._all, r.doc) == (i + 5, i + 6, i + 7, i) for i, r in got.items())


def test_marks_never_refuse_similar_lines(spark):
    """Pairs at and just above the similarity, of lines short and long enough to have shingles on every bit."""
    draw = random.Random(3)
    lines, n = [], 0
    while n < 300:
        length = draw.choice((60, 240, 1200, 4000))
        one = [chr(draw.randrange(97, 123)) for _ in range(length)]
        other = list(one)
        for _ in range(draw.randrange(1, length // 40 + 1)):
            other[draw.randrange(length)] = "#"
        a, b = grams("".join(one)), grams("".join(other))
        if 100 * len(a & b) >= 80 * len(a | b):
            lines += [(2 * n, "".join(one)), (2 * n + 1, "".join(other))]
            n += 1
    marks = line_dedup.digests(spark.createDataFrame(lines, "node long, line string"), K).collect()
    sizes = {r.node: r.n for r in marks}
    assert sizes == {node: len(grams(line)) for node, line in lines}
    found = spark.createDataFrame(marks).selectExpr("node div 2 as pair", "node % 2 as side", "n", "mark")
    a, b = (found.where(f"side = {s}").selectExpr("pair", f"n as n{s}", f"mark as m{s}") for s in (0, 1))
    pairs = a.join(b, "pair")
    columns = [pairs[c] for c in ("n0", "m0", "n1", "m1")]
    assert pairs.where(line_dedup._allowed(*columns, 80)).count() == n


def test_tables_of_rounds_are_removed(spark, documents):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.iterdir())
    rows = [(i, f"a line that many documents share, but for its number {i % 7}\nown {i * i}") for i in range(50)]
    line_dedup.deduplicated(documents(rows)).collect()
    left = {path.name.rsplit("-", 1)[0] for path in set(folder.iterdir()) - before}
    assert left == {"line-docs", "line-kept"}


def test_lines_of_the_same_words_make_few_candidates(spark):
    """Lines that share common words only share a band less often than 13 bands of 4 values would let them."""
    draw = random.Random(3)
    words = ["".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randrange(3, 8))) for _ in range(50)]
    lines = [(n, " ".join(draw.choice(words) for _ in range(40))) for n in range(400)]
    postings = line_dedup.banded(
        spark.createDataFrame(lines, "node long, line string"), K, line_dedup.BANDS, line_dedup.ROWS, 11
    )
    other = postings.selectExpr("key", "node as other")
    met = postings.join(other, "key").where("node < other").select("node", "other").distinct().count()
    sets = [grams(line) for _, line in lines]
    alike = [len(a & b) / len(a | b) for i, a in enumerate(sets) for b in sets[i + 1 :]]
    assert met < 0.7 * sum(1 - (1 - s**4) ** 13 for s in alike)


def test_recall_of_short_lines_at_the_similarity(spark):
    """Pairs of 8 to 70 shingles whose similarity is as near to 0.80 as their sizes allow."""
    draw = random.Random(13)
    lines, total = [], 0
    while total < 6000:
        n = draw.randrange(8, 71)
        cut = max(k for k in range(n) if 100 * (n - k) >= 80 * (n + k))
        one = "".join(chr(draw.randrange(97, 123)) for _ in range(n + K - 1))
        other = one[cut:] + "".join(draw.choice("0123456789") for _ in range(cut))
        if 100 * len(grams(one) & grams(other)) >= 80 * len(grams(one) | grams(other)):
            lines += [(2 * total, one), (2 * total + 1, other)]
            total += 1
    postings = line_dedup.banded(
        spark.createDataFrame(lines, "node long, line string"), K, line_dedup.BANDS, line_dedup.ROWS, 11
    )
    found = postings.selectExpr("key", "node div 2 as pair", "node % 2 as side").distinct()
    met = found.groupBy("key", "pair").count().where("count = 2").select("pair").distinct().count()
    assert met >= 0.9985 * total, met / total


def test_lines_are_signed_where_they_are(spark):
    """Neither a shuffle of lines nor a row for every shingle; a posting tells the size of the set."""
    lines = [(0, "abcdefgh"), (1, "é" * 300), (2, "".join(chr(200 + i) for i in range(400))), (3, "x😀yzw")]
    frame = spark.createDataFrame(lines, "node long, line string")
    postings = line_dedup.banded(frame, K, line_dedup.BANDS, line_dedup.ROWS, 11)
    plan = postings._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Generate") == 1
    rows = postings.collect()
    assert {r.node: r.info for r in rows} == {node: len(grams(line)) for node, line in lines}
    assert max(sum(r.node == node for r in rows) for node, _ in lines) <= line_dedup.BANDS


def test_sizes_that_may_not_link_need_no_digest(spark):
    postings = [(1, 1, 10), (1, 2, 30), (1, 3, 37), (2, 4, 10), (2, 5, 13), (3, 6, 8), (3, 7, 10), (3, 8, 20), (4, 9, 5)]
    shared = spark.createDataFrame(postings, "key long, node long, info int")
    assert {r.node for r in line_dedup.with_like_sizes(shared, 80).collect()} == {2, 3, 6, 7}


def test_the_last_step_makes_a_pair_once(spark):
    """Nodes that share three keys and are not linked: every pair between the ends is a row of the last join once."""
    postings = spark.createDataFrame([(k, n, 0) for k in (1, 2, 3) for n in range(12)], "key long, node long, info int")
    shared = links.with_hubs(postings)
    keys = shared.groupBy("node").agg(F.collect_set("key").alias("keys"))
    rows = [(k, a, b) for k in (1, 2, 3) for a in range(1, 11) for b in range(a + 1, 11)]
    known = spark.createDataFrame(rows, "key long, a long, b long")
    a = keys.select(F.col("node").alias("a"), F.struct("keys").alias("one"))
    b = keys.select(F.col("node").alias("b"), F.struct("keys").alias("other"))
    once = known.join(a, "a").join(b, "b").where(links._once(F.col("one"), F.col("other")))
    assert once.count() == 45 and {r.key for r in once.collect()} == {1}
    tested = []

    def verify(pairs):
        tested.extend((r.a, r.b) for r in pairs.collect())
        return pairs.where("a = 4 and b = 7")

    found = links.linked_components(shared, verify, lambda x, y: F.lit(True), "once", keys=keys).collect()
    assert {(r.node, r.component) for r in found} == {(4, 4), (7, 4)}
    assert set(tested) == {(a, b) for a in range(12) for b in range(a + 1, 12)} and len(tested) == len(set(tested))


def test_keys_of_one_node_leave_before_the_windows(spark):
    """Postings of keys that cannot make a pair go, in one shuffle; repeated postings and hot keys are kept whole."""
    rows = [(1, 1, 10), (2, 2, 10), (2, 2, 10), (3, 3, 10), (3, 4, 11), (4, 5, 10), (4, 6, 30), (5, 7, 10), (5, 8, 30), (5, 9, 40)]
    rows += [(6, n, 20) for n in range(10, 60)]
    postings = spark.createDataFrame(rows, "key long, node long, info int")
    met = line_dedup.of_two_nodes(postings, 80)
    assert sorted(map(tuple, met.collect())) == sorted(r for r in rows if r[0] in (3, 5, 6))
    final = met._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in final and "Window" not in final
    both = [line_dedup.with_like_sizes(links.with_hubs(p), 80).collect() for p in (postings, met)]
    assert sorted(map(str, both[0])) == sorted(map(str, both[1]))
    assert line_dedup.of_two_nodes(postings.limit(0), 80).count() == 0


def test_a_line_is_cut_once_for_a_digest_and_a_comparison(spark):
    lines = spark.createDataFrame([(0, "abcdefghijklmnop" * 3), (1, "abcdefghijklmnop" * 3 + "z"), (2, "q" * 40)], "node long, line string")
    marks = line_dedup.digests(lines, K)
    assert marks._jdf.queryExecution().optimizedPlan().toString().count("UTF-32") == 1
    pairs = spark.createDataFrame([(0, 1), (0, 2), (1, 2)], "a long, b long")
    found = line_dedup.similar(pairs, lines, marks, K, 80)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("UTF-32") == 2
    assert [(r.a, r.b) for r in found.collect()] == [(0, 1)]


def test_steps_read_only_lines_that_share_a_key(documents, monkeypatch):
    draw = random.Random(17)
    own = lambda: "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(80))
    shared = own()
    rows = [(i, own()) for i in range(200)] + [(200 + i, shared + str(i)) for i in range(6)]
    read, verify = [], line_dedup.similar

    def counting(pairs, lines, *rest):
        read.append(lines.count())
        return verify(pairs, lines, *rest)

    monkeypatch.setattr(line_dedup, "similar", counting)
    out = line_dedup.deduplicated(documents(rows).coalesce(1)).collect()
    assert sum(r.n_removed for r in out) == 5 and read and max(read) < 20, read
