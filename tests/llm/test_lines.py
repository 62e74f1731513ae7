import random
from itertools import combinations, product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dayline.llm import lines
from tests.llm.cases import documents, frame, prose


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        last, row = row, [i]
        for j, d in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (c != d)))
    return row[-1]


def edited(rng, line, n):
    for _ in range(n):
        i = rng.randrange(len(line) + 1)
        line = rng.choice([line[:i] + rng.choice("abé") + line[i:], line[:i] + line[i + 1:], line[:i] + "z" + line[i + 1:]])
    return line


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=14), st.text("abc", max_size=14), st.integers(0, 4))
def test_automaton(a, b, edits):
    assert lines.within(a, b, edits) == (distance(a, b) <= edits)


@pytest.mark.parametrize("edits", [0, 1, 2, 3])
def test_lines_within_the_edits_share_a_signature(edits):
    rng = random.Random(3)
    for _ in range(200):
        a = "".join(rng.choice("abcd") for _ in range(rng.randrange(28, 45)))
        b = edited(rng, a, rng.randrange(edits + 1))
        r, s = sorted((a, b), key=len)
        who, key, index = lines.signatures([r, s], edits)
        assert set(key[(who == 0) & index]) & set(key[who == 1])
        assert lines._first_shared(r, s, edits) >= 0
        # and a piece beside whatever segment they share
        i = lines._first_shared(r, s, edits)
        anew = [{row[3] for row in lines._dealt_anew(0, x, own, 7, {(len(r), i)}, edits) if row[5] or not own}
                for x, own in ((r, True), (s, False))]
        assert anew[0] & anew[1] and lines._first_shared(r, s, edits, i) >= 0
    start, size = zip(*(lines.segment(np.array([31]), i, edits) for i in range(edits + 1)))
    assert sum(int(x[0]) for x in size) == 31 and int(start[-1][0] + size[-1][0]) == 31


def plain(rows, edits=2):
    places, degree = {}, {}
    for doc, text, *_ in rows:
        for no, x in enumerate((text or "").split("\n")):
            if x.strip(" \t\v\f\r"):
                places.setdefault(x, set()).add(((1 << 63) - 1 if doc is None else doc, no))
    root = {x: x for x in places}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in combinations([x for x in places if len(x) >= 10], 2):
        most = min(edits, min(len(a), len(b)) // 10)
        if abs(len(a) - len(b)) <= most and distance(a, b) <= most:
            degree[a], degree[b] = degree.get(a, 0) + 1, degree.get(b, 0) + 1
            root[find(a)] = find(b)
    first = {}
    for x, where in places.items():
        first[find(x)] = min(first.get(find(x), min(where)), min(where))
    out = []
    for doc, text, *_ in rows:
        own = [(no, x) for no, x in enumerate((text or "").split("\n")) if x.strip(" \t\v\f\r")]
        gone = [no for no, x in own if first[find(x)] != ((1 << 63) - 1 if doc is None else doc, no)]
        out.append((doc, len(own), sum(degree.get(x, 0) for _, x in own), gone))
    return sorted(out, key=repr)


def cases():
    rng = random.Random(5)
    rows = [r for r in documents(30) if r[1] is None or len(r[1]) < 5000]
    base = [prose(rng, 6)[:60] for _ in range(6)] + ["short line", "the of and é the of and x"]
    for i in range(60):
        parts = [edited(rng, rng.choice(base), rng.choice([0, 1, 2, 3])) for _ in range(rng.randrange(1, 4))]
        rows.append((1000 + rng.randrange(500), "\n".join(parts + [prose(rng, 5)]), "en", "a", 0))
    return rows + [(3, "repeat\nrepeat\n\n  \nrepeat", "en", "a", 0)]


@pytest.mark.parametrize("length", [24, 31, 100])
@pytest.mark.parametrize("edits", [0, 1, 2, 3, 7])
def test_pieces_are_all_that_is_beside_a_segment(length, edits):
    for i in range(edits + 1):
        start, size = lines.segment(length, i, edits)
        covered = [n for j in range(edits + 1) for n in range(lines.piece(length, i, j, edits)[0], sum(lines.piece(length, i, j, edits)))]
        assert covered == [n for n in range(length) if not start <= n < start + size]


@pytest.mark.parametrize("refine_above", [2, 7, 1000])
def test_against_plain(spark, refine_above):
    rows = cases()
    docs = frame(spark, rows).withColumn("no", F.lit("clash")).withColumn("id", F.lit(0))
    got = lines.repeated_lines(docs, refine_above=refine_above).collect()
    want = plain(rows)
    assert sorted([(r.doc_id, r.n_lines, r.n_links, r.removed_lines) for r in got], key=repr) == want
    assert all(r.n_removed == len(r.removed_lines) for r in got) and sum(w[2] for w in want) > 100


@pytest.mark.parametrize("refine_above", [3, 1000])
def test_short_lines_against_plain(spark, refine_above):
    rng = random.Random(6)
    short = ["Are is anwh reenen.", "Are, is anwh reenen.", "今天天气很好。", "今天天氣很好", "x", "ab", "cde", "wxyz"]
    short += ["".join(rng.choices("abcdefgh", k=rng.randrange(1, 12))) for _ in range(60)]
    rows = [(i, "\n".join(rng.sample(short, 3)), "en", "a", 0) for i in range(40)] \
        + [(100, short[0], "en", "a", 0), (101, short[1], "en", "a", 0)]
    want = plain(rows)
    got = lines.repeated_lines(frame(spark, rows), refine_above=refine_above).collect()
    assert sorted([(r.doc_id, r.n_lines, r.n_links, r.removed_lines) for r in got], key=repr) == want
    assert distance(*short[:2]) <= 2 and {r.doc_id: r.n_links for r in got}[101] >= 1


def test_short_lines_are_the_same_only_if_equal(spark):
    """All 17,576 lines of three letters, some of them twice: one class for each."""
    words = ["".join(x) for x in product("abcdefghijklmnopqrstuvwxyz", repeat=3)]
    rows = [(i, "\n".join(words[i * 50:i * 50 + 50]), "en", "a", 0) for i in range(352)] + [(1000, "abc\nnine sign\nx", "en", "a", 0), (1001, "nine sig\nabd", "en", "a", 0)]
    got = {r.doc_id: r for r in lines.repeated_lines(frame(spark, rows)).collect()}
    assert {k: r.removed_lines for k, r in got.items() if r.removed_lines} == {1000: [0], 1001: [1]}
    assert not any(r.n_links for r in got.values())


def test_edits_grow_with_the_shorter_line(spark):
    """9, 10, 19 and 20 symbols, with one and with two edits, as replaced and as added symbols."""
    rows, want = [], {}
    for n in (9, 10, 19, 20):
        for k in range(4):
            one, other = chr(0x4e00 + 8 * n + k), chr(0x5e00 + 8 * n + k)
            changed = [one * (n - 1) + other, one * n + other, one * (n - 2) + 2 * other, one * n + 2 * other][k]
            rows.append((len(rows), f"{one * n}\n{changed}", "en", "a", 0))
            want[rows[-1][0]] = [1] if (1 if k < 2 else 2) <= min(2, n // 10) else []
    got = {r.doc_id: r.removed_lines for r in lines.repeated_lines(frame(spark, rows)).collect()}
    assert got == want and sorted(map(len, want.values())) == [0] * 8 + [1] * 8


def test_classes_can_be_put_together_from_the_result(spark):
    rows = cases()
    docs = {(r[0], no): x for r in rows for no, x in enumerate((r[1] or "").split("\n"))}
    members, of, gone = {}, {}, 0
    for r in lines.repeated_lines(frame(spark, rows)).collect():
        gone += len(r.removed_lines)
        assert {c.no for c in r.classes} >= set(r.removed_lines)
        for c in r.classes:
            members.setdefault(c["class"], set()).add(c.line)
            text = docs.get((r.doc_id, c.no))
            if r.doc_id is not None and [x[0] for x in rows].count(r.doc_id) == 1:
                assert of.setdefault(c.line, text) == text
            assert (c.n_links > 0) or c.no in r.removed_lines
    assert gone > 50 and any(len(m) > 2 for m in members.values())


def test_texts(spark):
    rows = [(1, "one and the same line for all of them\nown", "en", "a", 0), (2, "one and the same line for all of then\nx", "en", "b", 0),
            (3, None, "en", "a", 0)]
    got = {r.doc_id: (r.text, r.source) for r in lines.without_repeats(frame(spark, rows)).collect()}
    assert got == {1: (rows[0][1], "a"), 2: ("x", "b"), 3: (None, "a")}


def test_empty(spark):
    assert lines.repeated_lines(frame(spark, [])).count() == 0
