import hashlib
import random
import zlib
from itertools import product

from dayline.llm import turns
from dayline.llm.turns import audits, damaged, repaired

SCHEMA = "conv_id long, turn long, role string, text string"
ROLES = {"s": "system", "u": "user", "a": "assistant"}


def is_legal(initials):
    rest = initials[1:] if initials[:1] == ["s"] else initials
    return not initials or bool(rest) and len(rest) % 2 == 0 and all(x == "ua"[i % 2] for i, x in enumerate(rest))


def last_sign(text):
    return text.strip(turns.SPACE)[-1:]


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        end = last_sign(text)
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, letters, repaired lines): every state's whole string, compared as it is."""
    ways = {(): (0, "", ())}  # by what stands last: nothing, s, u, a

    def put(into, key, way):
        if key not in into or way[:2] < into[key][:2]:
            into[key] = way

    def following(last):
        return "a" if last == ("u",) else "u"

    def inserted(ways):
        for _ in range(3):
            for key, (cost, letters, lines) in list(ways.items()):
                x = following(key)
                put(ways, (x,), (cost + 3, letters + "I", (*lines, ROLES[x] + ":")))
        return ways
    for (_, role, text), fault in zip(rows, faults(rows)):
        new = {}
        for key, (cost, letters, lines) in inserted(ways).items():
            put(new, key, (cost + 4, letters + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault == "truncated" else 0
            x = following(key)
            if role[:1] == x or role[:1] == "s" and key == ():
                put(new, (role[:1],), (cost + more, letters + "K", (*lines, f"{role}:{text}")))
            put(new, (x,), (cost + more + 3, letters + "R", (*lines, f"{ROLES[x]}:{text}")))
        ways = new
    ends = [w for key, w in inserted(ways).items() if key in ((), ("a",))]
    return min(ends)


def exhaustive(rows, most=2):
    """The same by trying every string with up to ``most`` inserts at a place."""
    found = []
    for letters in product("DKR", repeat=len(rows)):
        for holes in product(range(most + 1), repeat=len(rows) + 1):
            for new in product("ua", repeat=letters.count("R") + sum(holes)):
                queue, out, cost, word, ok = list(new), [], 0, "", True
                for i in range(len(rows) + 1):
                    out += [queue.pop(0) for _ in range(holes[i])]
                    cost, word = cost + 3 * holes[i], word + "I" * holes[i]
                    if i == len(rows):
                        break
                    word += letters[i]
                    fault = faults(rows)[i]
                    ok &= letters[i] == "D" or fault not in ("blank", "duplicate")
                    cost += {"D": 4, "K": 0, "R": 3}[letters[i]] + 3 * (fault == "truncated" and letters[i] != "D")
                    out += [] if letters[i] == "D" else [rows[i][1][:1] if letters[i] == "K" else queue.pop(0)]
                if ok and is_legal(out):
                    found.append((cost, word))
    return min(found)


def plain(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = []
    for conv, held in convs.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        found, numbers = faults(held), [t for t, _, _ in held if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(held, held[1:]))
        cost, letters, lines = cheapest(held)
        out.append((conv, gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, letters,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(seed=3, n=80, longest=9):
    rng, rows = random.Random(seed), []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            if rng.random() < 0.1:
                continue
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "uncle"])
            text = rng.choice(["Yes.", "no", "Go on!", " \t", "", "a ? ", None, "ok\u00a0", f"x{turn}.", f"y{turn}"])
            rows.append((conv if conv else None, rng.choice([turn, turn, turn, None, turn + 5, 1]), role, text))
            if rng.random() < 0.2:
                rows.append(rows[-1])
    return rows


def test_against_plain(spark):
    rows = conversations()
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS piece", "'x' AS letters", "2 AS at")
    assert sorted(map(tuple, audits(docs).collect()), key=repr) == plain(rows)


def test_pieces_of_long_conversations(spark):
    """Every conversation in pieces, some with hundreds of rows, equal rows and ties over piece ends."""
    rows = conversations(4, 12, 60)
    rng = random.Random(5)
    rows += [(100, i // 3, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "no", f"x{i}.", ""])) for i in range(400)]
    rows += [(101, None, "user", "the same.")] * 150 + [(102, i, "user", f"{i}.") for i in range(150)]
    rows += [(103, i, "assistant", "again.") for i in range(90)] + [(104, i, "ua"[i % 2] + "x", f"{i}.") for i in range(101)]
    got = audits(spark.createDataFrame(rows, SCHEMA), long_rows=3, piece_rows=40)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)
    lines = {}
    for r in repaired(spark.createDataFrame(rows, SCHEMA), long_rows=3, piece_rows=40).collect():
        lines.setdefault(r.conv_id, []).append((r.place, f"{r.role}:{r.text}"))
    want = {conv: sha for conv, *_, sha in plain(rows)}
    for conv, sha in want.items():
        text = "\n".join(x for _, x in sorted(lines.get(conv, [])))
        assert hashlib.sha256(text.encode()).hexdigest() == sha


def test_long_by_bytes(spark):
    rows = [(1, 0, "user", "x" * 5000), (1, 1, "assistant", "y" * 9000 + ". \n"), (2, 0, "user", "short.")]
    got = audits(spark.createDataFrame(rows, SCHEMA), long_bytes=1000)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)


def test_cheapest_is_cheapest():
    rng = random.Random(8)
    for _ in range(60):
        rows = [(i, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["Yes.", "no", "", f"{i}!"]))
                for i in range(rng.randint(1, 3))]
        want = exhaustive(rows)
        assert cheapest(rows)[:2] == want
        assert turns.mend(rows)[1:] == want


def test_equal_hashes_are_verified(monkeypatch):
    """A rolling hash that never tells strings apart changes nothing."""
    monkeypatch.setattr(turns, "_rolled", lambda value, letters: 0)
    rng = random.Random(9)
    for _ in range(200):
        rows = [(i, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "no", "", f"{i}!"])) for i in range(rng.randint(1, 12))]
        assert turns.mend(rows)[1:] == cheapest(rows)[:2]


def test_damage(spark):
    rows = conversations(6, 200)
    want = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k:
            row = (conv, turn, "user" if k == 4 else role, "" if k == 1 else "".join(x for x in text if x not in ".!?") if k == 2 else text)
            want += [row] * (1 + (k == 3))
    got = damaged(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, got.where("alive").drop("alive").collect()), key=repr) == sorted(want, key=repr)


def test_query_keeps_every_conversation(spark, tmp_path):
    from dayline.llm.queries import op11_conversation_repair
    rows = [(c, 0, "user", "Yes.") for c in range(60)] + [(None, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in op11_conversation_repair(spark, str(tmp_path)).collect()}
    assert set(got) == {r[0] for r in rows}
    dropped = next(c for c in range(60) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert tuple(got[dropped])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert got[None].blank in (0, 1)


def test_empty(spark):
    assert audits(spark.createDataFrame([], SCHEMA)).count() == 0
    assert repaired(spark.createDataFrame([], SCHEMA)).count() == 0
