"""Documents with what may go wrong in any column, and rows to plant."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and ertion ingou wher thand blere onat shion reont thesta inlyer ourand stionre".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "ed", "ing", "ly."]) for _ in range(n))


def documents(n=60, seed=1):
    """Rows with nulls, empty and long texts, ties, repeated rows and one source with a third."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = prose(rng, rng.choice([1, 3, 12, 40, 90]))
        if i % 5 == 0:
            text = text.replace(" ", "\n", 2)
        rows.append((i, text, rng.choice(["en", "de", None]), "hot" if i % 3 == 0 else rng.choice(["a", "B", "é", None]), len(text)))
    rows += [(n, None, "en", "a", None), (n + 1, "", None, None, 0), (n + 2, " \t\n ", "en", "a", 4),
             (n + 3, prose(rng, 4000), "en", "a", 1), (n + 4, rows[7][1], "de", "hot", 1), (n + 5, rows[7][1], "en", "a", 1),
             rows[9], rows[9], (None, "the of and the of", "en", "hot", 3), (None, None, None, None, None),
             (n + 6, "ÀÉ ñandú — 漢字 x", "es", "a", 9)]
    return rows


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA)
