"""Exact dedup and line dedup against brute force."""

import hashlib
import random

import oracle_compare
import pytest
from cases import SF, TEXTS, Groups, documents, edge_docs, empty_docs

from orderloom.llm import exact_dedup, line_dedup
from orderloom.llm.oracles import ORACLES
from orderloom.llm.queries import QUERIES


def test_exact_query_matches_sql(spark):
    con = oracle_compare.connect(SF)
    assert oracle_compare.compare(spark, con, SF, "op2_exact_dedup", QUERIES["op2_exact_dedup"], ORACLES["op2_exact_dedup"]) == ""


@pytest.mark.parametrize("keep", ["min", "max"])
def test_exact_edges(spark, keep):
    rows = exact_dedup.exact_groups(edge_docs(spark), keep=keep).collect()
    by_text = {}
    for i, t in TEXTS:
        by_text.setdefault(t or "", []).append(i)
    want = []
    for i, t in TEXTS:
        ids = by_text[t or ""]
        best = {"min": min, "max": max}[keep](ids) if None not in ids else None
        want.append((i, best, len(ids), i == best, hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)
    assert exact_dedup.exact_groups(empty_docs(spark)).count() == 0


def test_exact_hot_text_over_many_ranges(spark):
    docs = spark.createDataFrame([(i, "same text" if i % 3 else f"other {i}") for i in range(3000)], "doc_id long, text string")
    rows = exact_dedup.exact_groups(docs, keep="max", per_range=64).collect()
    assert {r.keep_id for r in rows if r.doc_id % 3} == {2999 if 2999 % 3 else 2998}
    assert {r.group_size for r in rows if r.doc_id % 3} == {2000}
    assert all(r.kept and r.group_size == 1 for r in rows if r.doc_id % 3 == 0)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(rnd, text, times):
    out = list(text)
    for _ in range(times):
        at, how = rnd.randint(0, len(out)), rnd.random()
        if how < 0.33 or not out:
            out.insert(at, rnd.choice("abcd"))
        elif how < 0.66:
            out.pop(min(at, len(out) - 1))
        else:
            out[min(at, len(out) - 1)] = rnd.choice("abcd")
    return "".join(out)


def test_banded_distance():
    rnd = random.Random(1)
    for _ in range(5000):
        a = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 12)))
        b, limit = changed(rnd, a, rnd.randint(0, 4)), rnd.randint(0, 3)
        assert line_dedup.within(a, b, limit) == (edits(a, b) <= limit)


def test_keys_of_close_lines_meet():
    rnd = random.Random(2)
    for _ in range(3000):
        a = "".join(rnd.choice("abcd") for _ in range(rnd.randint(20, 70)))
        b = changed(rnd, a, rnd.randint(1, 2))
        if len(b) < 20 or edits(a, b) > line_dedup.allowed(min(len(a), len(b)), 2):
            continue
        (ia, pa), (ib, pb) = line_dedup.index_and_probe_keys(a, 2), line_dedup.index_and_probe_keys(b, 2)
        assert set(ia) & set(pb) or set(ib) & set(pa)


def test_line_ids_are_sparks(spark):
    lines = ["", "abc", "é 𝒳", "x" * 500]
    got = spark.createDataFrame([(x,) for x in lines], "x string").selectExpr("xxhash64(x)").collect()
    assert [r[0] for r in got] == [line_dedup.line_id(x) for x in lines]


def removed_by_brute_force(docs):
    lines = sorted({x.strip() for _, t in docs for x in t.split("\n") if len(x.strip()) >= 20})
    groups = Groups()
    for i, a in enumerate(lines):
        for b in lines[:i]:
            if abs(len(a) - len(b)) <= 2 and line_dedup.within(a, b, line_dedup.allowed(min(len(a), len(b)), 2)):
                groups.join(a, b)
    seen, out = {}, []
    order = sorted(range(len(docs)), key=lambda k: docs[k][0])
    for k in order:
        i, text = docs[k]
        gone = []
        for no, line in enumerate(text.split("\n")):
            if len(line.strip()) >= 20 and seen.setdefault(groups.find(line.strip()), (i, text, no)) != (i, text, no):
                gone.append(no)
        out.append((i, ",".join(map(str, gone))))
    return sorted(out)


def test_lines_query(spark):
    got = QUERIES["op3_line_dedup"](spark, SF).select("doc_id", "removed_lines").collect()
    assert sorted(map(tuple, got)) == removed_by_brute_force(documents())


def test_lines_edges(spark):
    rows = line_dedup.repeated_lines(edge_docs(spark)).collect()
    got = sorted(((r.doc_id or 0, r.n_lines, r.removed) for r in rows), key=repr)
    assert (4, 3, []) in got and (5, 3, [0, 2]) in got and got.count((6, 3, [0])) == 2
    assert (1, 1, []) in got and (2, 1, []) in got and (0, 1, []) in got and len(got) == len(TEXTS)
    cut = {r.doc_id: r for r in line_dedup.without_repeated_lines(edge_docs(spark)).collect()}
    assert cut[5].text == "short" and cut[4].text == TEXTS[3][1] and cut[1].text is None and cut[5].n_lines == 5 and cut[5]["__text"] == "clash"
    assert line_dedup.repeated_lines(empty_docs(spark)).count() == 0
    assert line_dedup.without_repeated_lines(empty_docs(spark)).count() == 0


def test_lines_group_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK_LINES", 7)
    base = "a line with a number at its end and some more words 0"
    docs = spark.createDataFrame([(i, base[:-1] + chr(65 + i)) for i in range(40)], "doc_id long, text string")
    rows = line_dedup.repeated_lines(docs).collect()
    assert sorted((r.doc_id, r.removed) for r in rows) == [(i, [0] if i else []) for i in range(40)]


def test_lines_of_one_large_family_meet_in_linear_rows(spark, monkeypatch):
    """Near copies share their segments: what is staged may not grow by pairs of blocks."""
    from orderloom.llm import blocks

    counts = []

    def counted(df, label):
        out = staged(df, label)
        counts.append((label, out.count()))
        return out

    staged = line_dedup.stage
    monkeypatch.setattr(line_dedup, "BLOCK_LINES", 8)
    for module in (line_dedup, blocks):
        monkeypatch.setattr(module, "stage", counted, raising=False)
    rnd = random.Random(3)
    lines = sorted({"the same template in all of them and then number " + "".join(rnd.choice("ab") for _ in range(10)) for _ in range(2500)})
    docs = list(enumerate(lines))
    rows = line_dedup.repeated_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, ",".join(map(str, r.removed))) for r in rows) == removed_by_brute_force(docs)
    # A line has a fixed number of index and probe entries; everything behind them is smaller.
    assert len(lines) > 800 and all(n < (40 if label == "lines-entries" else 20) * len(lines) for label, n in counts)


def test_lines_of_a_large_group_that_order_does_not_join(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK_LINES", 4)
    rnd = random.Random(4)
    ends = ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(60)]
    ends += [changed(rnd, e, 2) for e in ends]
    docs = list(enumerate(e + " one template that stands in each line, word for word" for e in ends))
    rows = line_dedup.repeated_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, ",".join(map(str, r.removed))) for r in rows) == removed_by_brute_force(docs)
