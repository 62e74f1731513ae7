import re
from collections import Counter, defaultdict

import duckdb
from pyspark.sql import functions as F

from dayline.llm import rules
from dayline.llm.queries import RULES_SQL
from tests.llm.cases import documents, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, line_docs, depleted=0.5):
    lines = defaultdict(set)

    def normal(x):
        return re.sub("[0-9]", "0", re.sub(r"[\x20\x09-\x0D]+", " ", x).strip(" ")).lower()
    for _, text, _, source, _ in rows:
        for x in (text or "").split("\n"):
            if WORD.search(x):
                lines[source, normal(x)].add(text)
    out = []
    for doc, text, _, source, _ in rows:
        text = text or ""
        w = WORD.findall(text)
        grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        hit = {j for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
        seen = [x for x in text.split("\n") if WORD.search(x)]
        gone = sum(len(WORD.findall(x)) for x in seen if len(lines[source, normal(x)]) > line_docs)
        failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
        out.append((doc, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(seen) - len(set(seen)),
                    len(hit), failed, gone, not failed and gone <= depleted * len(w)))
    return sorted(out, key=repr)


def cases():
    rows = documents(40)
    long = " ".join(f"word{i}" for i in range(25))
    for i in range(30):  # a footer of one host, in many texts
        body = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + j)}" for j in range(25))
        rows.append((700 + i, f"{body}\nPage {i} of 9 | <b>\n" + ("All  rights\treserved for ever and ever " * 4 if i % 2 else "own"),
                     "en", "hot" if i < 20 else "a", 0))
    rows += [(800, (long + "\n") * 5, "en", "a", 0), (801, "a b c d e f g h " * 6, "en", None, 0),
             (802, long + " 1 2 3 " + long, "en", None, 0), (803, "x y z\n \nx y z\nx y  z", "en", "a", 0)]
    return rows


COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "removed_words", "kept")


def test_against_plain(spark):
    rows = cases()
    docs = frame(spark, rows).withColumn("host", F.lit("clash")).withColumn("line", F.lit(1))
    got = rules.judge(docs, line_docs=5).select(*COLUMNS).collect()
    want = plain(rows, 5)
    assert sorted(map(tuple, got), key=repr) == want
    assert any(not w[6] and not w[8] for w in want) or any(w[7] for w in want)


def test_sql_on_cases(spark):
    rows = list({r[0]: r for r in cases() if r[0] is not None}.values())
    con = duckdb.connect()
    con.register("documents", frame(spark, rows).toArrow())
    names = ", ".join(c for c in COLUMNS if c != "removed_words")
    want = sorted(map(tuple, con.sql(f"SELECT {names} FROM ({RULES_SQL})").fetchall()), key=repr)
    got = rules.judge(frame(spark, rows)).select(*[c for c in COLUMNS if c != "removed_words"]).collect()
    assert sorted(map(tuple, got), key=repr) == want


def test_cleaned_texts(spark):
    rows = cases()
    kept = {r.doc_id: r for r in rules.cleaned(frame(spark, rows), line_docs=5).collect()}
    verdict = {r[0]: r[-1] for r in plain(rows, 5)}
    assert set(kept) == {k for k, v in verdict.items() if v}
    assert kept[700].text.splitlines()[1:] == [] and kept[700].source == "hot"
    assert kept[720].text.splitlines()[-1] == "own"  # five texts of its host have the line, no more than the limit


def test_limit_does_not_grow_with_the_host(spark):
    """A line on 50 of 60,000 pages, most of them copies, goes as it does in a small host."""
    body = " ".join(f"word{i}" for i in range(25))
    rows = [(i, f"{' '.join(f'u{i}x{j}' for j in range(20))}\n{'all rights reserved ' * 10}", "en", "big" if i < 50 else "small", 0)
            for i in range(61)]
    docs = frame(spark, rows).unionByName(
        spark.range(1000, 60_950).selectExpr("id AS doc_id", f"'{body}' AS text", "'en' AS lang", "'big' AS source", "0L AS n_chars"))
    got = rules.judge(docs).select("doc_id", "kept")
    assert sorted(r.doc_id for r in got.where(~F.col("kept")).collect()) == list(range(61))
    assert got.count() == 60_011


def test_empty(spark):
    assert rules.judge(frame(spark, [])).count() == 0
    assert rules.cleaned(frame(spark, [])).count() == 0
