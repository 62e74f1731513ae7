"""Conversation structure repair: the cheapest edits that give ``(s?(ua)+)?``, by a persistent audit DP.

The edits of a conversation are written as a string, one letter each: ``D`` delete, ``I`` insert,
``K`` keep, ``R`` set another role. The dynamic programme holds, for each state of the pattern, its
least cost and the least string of that cost. Strings are never copied: a string is a node that adds
letters to a parent (:class:`Trails`), so all states share their prefixes. Each node knows its
ancestors at distances 1, 2, 4, ... and a rolling hash of its whole string; two strings of equal cost
are compared at the end of their longest common prefix, which a search over hashed prefixes finds and
a comparison of the letters since their last shared node verifies.

A conversation of up to ``LONG_ROWS`` rows and ``LONG_BYTES`` bytes is one unit of work. Longer ones
are cut into pieces by ranges of their order: each piece gives the cheapest string from every state to
every state (its rows need not be together with others), the pieces of a conversation are chained by
the same programme with whole strings as letters, and the texts pass once more, in order, through a
running hash. Only what the result itself holds, the audit string, grows with a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from dayline.llm.text import stored

LONG_ROWS = 2048  # of a conversation that one task takes whole
LONG_BYTES = 16 << 20
PIECE_ROWS = 2048  # aimed at in a piece of a longer one
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3  # costs; the last for a truncated row that stays
SPACE = " \t\n\x0b\x0c\r"
STOPS = (".", "!", "?")
NONE, SYSTEM, USER, ASSISTANT = range(4)  # what stands last: states of the pattern
LEGAL = ("su", "ua", "au")
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
ORDER = ("conv_id", "turn", "role", "text")  # ascending, nulls first
_PRIME = (1 << 61) - 1
_BASE = 1_000_003


class Trails:
    """Strings as linked nodes; node 0 is the empty string."""

    def __init__(self):
        self.letters, self.depth, self.level, self.hash, self.up = [""], [0], [0], [0], [()]

    def add(self, node: int, letters: str) -> int:
        ups, at = [node], 0
        while at < len(self.up[ups[-1]]):
            ups.append(self.up[ups[-1]][at])
            at += 1
        self.letters.append(letters)
        self.depth.append(self.depth[node] + len(letters))
        self.level.append(self.level[node] + 1)
        self.hash.append(_rolled(self.hash[node], letters))
        self.up.append(tuple(ups))
        return len(self.letters) - 1

    def holder(self, node: int, n: int) -> int:
        """The node of the chain that holds letter ``n``, which must lie below the node's depth."""
        for k in reversed(range(len(self.up[node]))):
            if k < len(self.up[node]) and self.depth[self.up[node][k]] > n:
                node = self.up[node][k]
        return node

    def prefix_hash(self, node: int, n: int) -> int:
        if n == self.depth[node]:
            return self.hash[node]
        node = self.holder(node, n)
        parent = self.up[node][0]
        return _rolled(self.hash[parent], self.letters[node][:n - self.depth[parent]])

    def letter(self, node: int, n: int) -> str:
        node = self.holder(node, n)
        return self.letters[node][n - self.depth[self.up[node][0]]]

    def string(self, node: int, since: int = 0) -> str:
        """The letters after the ancestor ``since``."""
        parts = []
        while node != since:
            parts.append(self.letters[node])
            node = self.up[node][0]
        return "".join(reversed(parts))

    def chain(self, node: int) -> list[str]:
        """The letters of each node from the first to this one."""
        parts = []
        while node:
            parts.append(self.letters[node])
            node = self.up[node][0]
        return parts[::-1]

    def shared(self, a: int, b: int) -> int:
        """The last node that both chains hold."""
        if self.level[a] < self.level[b]:
            a, b = b, a
        ahead, k = self.level[a] - self.level[b], 0
        while ahead >> k:
            if ahead >> k & 1:
                a = self.up[a][k]
            k += 1
        for k in reversed(range(len(self.up[a]))):
            if a != b and k < len(self.up[a]) and self.up[a][k] != self.up[b][k]:
                a, b = self.up[a][k], self.up[b][k]
        return a if a == b else self.up[a][0]

    def common(self, a: int, b: int) -> int:
        """The length of the longest common prefix."""
        met = self.shared(a, b)
        low, high = self.depth[met], min(self.depth[a], self.depth[b])
        first = low
        while low < high:
            mid = (low + high + 1) // 2
            if self.prefix_hash(a, mid) == self.prefix_hash(b, mid):
                low = mid
            else:
                high = mid - 1
        if low > first:  # equal hashes: look at the letters themselves
            x, y = self.string(a, met), self.string(b, met)
            if x[:low - first] != y[:low - first]:
                return first + next(i for i, (p, q) in enumerate(zip(x, y)) if p != q)
        return low

    def less(self, a: int, b: int) -> bool:
        n = self.common(a, b)
        if n in (self.depth[a], self.depth[b]):
            return self.depth[a] < self.depth[b]
        return self.letter(a, n) < self.letter(b, n)


def _rolled(value: int, letters: str) -> int:
    for x in letters:
        value = (value * _BASE + ord(x)) % _PRIME
    return value


class Programme:
    """Least cost and least string of each state, from one state before the first row."""

    def __init__(self, trails: Trails, start: int = NONE):
        self.trails = trails
        self.best: list[tuple[int, int] | None] = [None] * 4
        self.best[start] = (0, 0)

    def _offer(self, best, state: int, cost: int, node: int, letters: str) -> None:
        held = best[state]
        if held is None or cost < held[0]:
            best[state] = (cost, self.trails.add(node, letters))
        elif cost == held[0]:
            made = self.trails.add(node, letters)
            if self.trails.less(made, held[1]):
                best[state] = (cost, made)

    def inserts(self) -> None:
        """Empty user and assistant rows at this place."""
        for x in (NONE, SYSTEM, ASSISTANT):
            if self.best[x]:
                self._offer(self.best, USER, self.best[x][0] + INSERT, self.best[x][1], "I")
        if self.best[USER]:
            self._offer(self.best, ASSISTANT, self.best[USER][0] + INSERT, self.best[USER][1], "I")

    def row(self, initial: str, forced: bool, truncated: bool) -> None:
        self.inserts()
        new: list[tuple[int, int] | None] = [None] * 4
        for state, held in enumerate(self.best):
            if not held:
                continue
            cost, node = held
            self._offer(new, state, cost + DELETE, node, "D")
            if forced:
                continue
            cost += CUT_OFF * truncated
            then = ASSISTANT if state == USER else USER
            if initial == "s" and state == NONE:
                self._offer(new, SYSTEM, cost, node, "K")
            elif initial == "ua"[then == ASSISTANT]:
                self._offer(new, then, cost, node, "K")
            self._offer(new, then, cost + REROLE, node, "R")
        self.best = new

    def deletes(self, n: int) -> None:
        """``n`` rows that must go, alike: inserts among them are never the least string."""
        if n:
            self.inserts()
            self.best = [held and (held[0] + DELETE * n, self.trails.add(held[1], "D" * n)) for held in self.best]

    def chain(self, piece: list[list[tuple[int, str] | None]]) -> None:
        """A piece of rows by its cheapest strings from state to state."""
        new: list[tuple[int, int] | None] = [None] * 4
        for held, row in zip(self.best, piece):
            for state, way in enumerate(row):
                if held and way:
                    self._offer(new, state, held[0] + way[0], held[1], way[1])
        self.best = new

    def end(self) -> tuple[int, int]:
        """Cost and string of the whole: nothing, or an assistant row last."""
        self.inserts()
        (none, last) = self.best[NONE], self.best[ASSISTANT]
        if none and last:
            if none[0] == last[0]:
                return none if self.trails.less(none[1], last[1]) else last
            return min(none, last)
        return none or last


class Tally:
    """Counts of rows in order: first faults, illegal neighbours, gaps of turns."""

    NUMBERS = ("blank", "duplicate", "truncated", "illegal", "turns", "least", "most")

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = None  # initials
        self.least = self.most = None  # turns

    def row(self, turn, initial: str, blank: bool, duplicate: bool, truncated: bool, n: int = 1) -> None:
        self.blank += n if blank else 0
        self.duplicate += 0 if blank else n if duplicate else n - 1
        self.truncated += truncated and not blank and not duplicate
        if self.last is not None and self.last + initial not in LEGAL:
            self.illegal += 1
        self.illegal += n - 1
        self.first = initial if self.first is None else self.first
        self.last = initial
        if turn is not None and turn != self.most:
            self.turns += 1
            self.least, self.most = turn if self.least is None else self.least, turn

    @classmethod
    def of(cls, values: list) -> Tally:
        """From NUMBERS, first and last."""
        tally = cls()
        for name, value in zip((*cls.NUMBERS, "first", "last"), values):
            setattr(tally, name, value)
        return tally

    def then(self, later: Tally) -> None:
        for k in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, k, getattr(self, k) + getattr(later, k))
        if later.first is None:
            return
        self.illegal += self.last is not None and self.last + later.first not in LEGAL
        self.first, self.last = later.first if self.first is None else self.first, later.last
        if later.least is not None:
            self.turns += later.turns - (later.least == self.most)
            self.least, self.most = later.least if self.least is None else self.least, later.most

    def values(self) -> tuple[int, ...]:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal


class Mended:
    """The repaired rows, in order, from the letters of their edits."""

    def __init__(self):
        self.state = NONE

    def _next(self) -> str:
        self.state = ASSISTANT if self.state == USER else USER
        return "assistant" if self.state == ASSISTANT else "user"

    def rows(self, letters: str, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of what the letters of one row, or of none, leave."""
        for x in letters:
            if x == "I":
                yield x, self._next(), ""
            elif x == "R":
                yield x, self._next(), text
            elif x == "K":
                self.state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[:1]]
                yield x, role, text


def mend(rows: list[tuple]) -> tuple[tuple[int, ...], int, str]:
    """Counts, cost and audit of a whole conversation of (turn, role, text) in order."""
    tally, programme, seen = Tally(), Programme(Trails()), set()
    for turn, role, text in rows:
        end = text.rstrip(SPACE)[-1:]
        duplicate = bool(end) and (role, text) in seen
        seen.add((role, text))
        tally.row(turn, role[:1], not end, duplicate, end not in ("", *STOPS))
        programme.row(role[:1], not end or duplicate, end not in ("", *STOPS))
    cost, node = programme.end()
    return tally.values(), cost, programme.trails.string(node)


def by_row(audit: str) -> Iterator[str]:
    """The letters of each row, inserts before it included; the last ones stand behind all rows."""
    held = ""
    for x in audit:
        held += x
        if x != "I":
            yield held
            held = ""
    yield held


def _groups(rows: Iterator[tuple]) -> Iterator[tuple[object, list[tuple]]]:
    """Rows in order by their first value."""
    now, held = None, []
    for key, *rest in rows:
        if held and key != now:
            yield now, held
            held = []
        now = key
        held.append(tuple(rest))
    if held:
        yield now, held


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _write(rows: Iterator[tuple], schema: T.StructType, size: int) -> Iterator[pa.RecordBatch]:
    arrow = to_arrow_schema(schema)
    while held := list(islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)


# What a task makes of conversations in order: events (conv_id, letters, role, text, done), one for
# each row, and one behind the last row with ``done``, the counts, the cost and the audit.
Events = Iterator[tuple[object, str, str, str, tuple | None]]


def _digests(events: Events) -> Iterator[tuple]:
    """One row for each conversation, with the hash of its repaired rows."""
    out, sha, join = Mended(), hashlib.sha256(), ""
    for conv, letters, role, text, done in events:
        for _, new, line in out.rows(letters, role, text):
            sha.update(f"{join}{new}:{line}".encode())
            join = "\n"
        if done:
            yield conv, *done, sha.hexdigest()
            out, sha, join = Mended(), hashlib.sha256(), ""


def _repaired(events: Events) -> Iterator[tuple]:
    """The repaired rows themselves."""
    out, place = Mended(), 0
    for conv, letters, role, text, done in events:
        for edit, new, line in out.rows(letters, role, text):
            yield conv, place, edit, new, line
            place += 1
        if done:
            out, place = Mended(), 0


def _short(rows: DataFrame, sink: Callable[[Events], Iterator[tuple]], schema: T.StructType) -> DataFrame:
    """Conversations whole, many to a task."""
    def run(batches):
        def events():
            for conv, held in _groups(_read(batches)):
                counts, cost, audit = mend(held)
                letters = by_row(audit)
                for (_, role, text), x in zip(held, letters):
                    yield conv, x, role, text, None
                yield conv, next(letters), "", "", (*counts, cost, audit)
        return _write(sink(events()), schema, 1000)

    return rows.repartition("conv_id").sortWithinPartitions(*ORDER).mapInArrow(run, schema)


def _pieces(rows: DataFrame, piece_rows: int) -> DataFrame:
    """Rows of long conversations, equal ones as one with their number, in ranges of the order.

    Columns: conv_id, turn, role, text, n, duplicate, piece, at (the place within the piece).
    """
    same = stored(rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n"))
                  .withColumn("same", F.sha2("text", 256)), "turn-rows")
    first = same.groupBy("conv_id", "role", "same").agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn")).alias("_first")) \
        .withColumnsRenamed({"conv_id": "_conv", "role": "_role", "same": "_same"})
    met = same.join(first, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role"))
                    & (F.col("same") == F.col("_same")))
    flagged = stored(met.select("conv_id", "turn", "role", "text", "n",
                                (~F.col("turn").eqNullSafe(F.col("_first.turn"))).alias("duplicate")), "turn-flags")
    parts = max(1, -(-flagged.count() // piece_rows))
    ranged = flagged.repartitionByRange(parts, *ORDER).sortWithinPartitions(*ORDER)
    return stored(ranged.withColumns({"piece": F.spark_partition_id().cast("long"),
                                      "at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "turn-pieces")


def _ways(pieces: DataFrame) -> DataFrame:
    """The counts of each piece of a conversation and its cheapest strings from state to state."""
    way = T.StructType([T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())])
    schema = T.StructType([pieces.schema["conv_id"], pieces.schema["piece"], *[T.StructField(c, T.LongType()) for c in Tally.NUMBERS],
                           T.StructField("first", T.StringType()), T.StructField("last", T.StringType()),
                           T.StructField("ways", T.ArrayType(way))])

    def run(batches):
        def results():
            rows = (((piece, conv), *rest) for conv, piece, *rest in _read(batches))
            for (piece, conv), held in _groups(rows):
                tally, ways = Tally(), []
                for turn, initial, end, duplicate, n in held:
                    tally.row(turn, initial, not end, duplicate, end not in ("", *STOPS), n)
                for start in range(4):
                    programme = Programme(Trails(), start)
                    for _, initial, end, duplicate, n in held:
                        programme.row(initial, not end or duplicate, end not in ("", *STOPS))
                        programme.deletes(n - 1)
                    ways += [best and {"cost": best[0], "audit": programme.trails.string(best[1])} for best in programme.best]
                yield conv, piece, *[getattr(tally, c) for c in (*Tally.NUMBERS, "first", "last")], ways
        return _write(results(), schema, 16)

    narrow = pieces.select("conv_id", "piece", "at", "turn", F.substring("role", 1, 1).alias("initial"),
                           F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1).alias("end"), "duplicate", "n")
    return narrow.repartition("piece").sortWithinPartitions("piece", "at").drop("at").mapInArrow(run, schema)


def _plans(ways: DataFrame) -> DataFrame:
    """The letters of each piece in the cheapest string of its conversation; counts, cost and audit at the last."""
    done = T.StructType([*[T.StructField(c, T.LongType()) for c in COUNTS], T.StructField("audit", T.StringType())])
    schema = T.StructType([ways.schema["conv_id"], ways.schema["piece"], T.StructField("letters", T.StringType()),
                           T.StructField("done", done)])

    def run(batches):
        def results():
            for conv, held in _groups(_read(batches)):
                tally, programme = Tally(), Programme(Trails())
                for _, *counts, ways in held:
                    tally.then(Tally.of(counts))
                    ways = [way and (way["cost"], way["audit"]) for way in ways]
                    programme.chain([ways[4 * k:4 * k + 4] for k in range(4)])
                cost, node = programme.end()
                letters = programme.trails.chain(node)  # one for each piece, then inserts at the end
                letters[len(held) - 1:] = ["".join(letters[len(held) - 1:])]
                counts = (*tally.values(), cost, "".join(letters))
                for (piece, *_), x in zip(held, letters):
                    yield conv, piece, x, dict(zip(done.names, counts)) if piece == held[-1][0] else None
        return _write(results(), schema, 16)

    return ways.repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(run, schema)


def _long(rows: DataFrame, sink: Callable[[Events], Iterator[tuple]], schema: T.StructType, piece_rows: int) -> DataFrame:
    """Conversations in pieces; only their texts pass in order through one task, none held."""
    pieces = _pieces(rows, piece_rows)
    plans = stored(_plans(_ways(pieces)), "turn-plans")

    def run(batches):
        def events():
            letters, done, now = iter(()), None, None
            for conv, _, at, plan, ready, role, text, n in _read(batches):
                if at < 0:  # the plan of a piece comes before its rows
                    for x in letters:  # inserts behind the last row of the piece before
                        yield now, x, "", "", done
                    letters, done, now = by_row(plan), ready and tuple(ready.values()), conv
                for _ in range(n):
                    yield conv, next(letters), role, text, None
            for x in letters:
                yield now, x, "", "", done
        return _write(sink(events()), schema, 1000)

    lines = plans.select("conv_id", "piece", F.lit(-1).cast("long").alias("at"), "letters", "done", F.lit("").alias("role"),
                         F.lit("").alias("text"), F.lit(0).cast("long").alias("n"))
    texts = pieces.select("conv_id", "piece", "at", F.lit(None).cast("string").alias("letters"),
                          F.lit(None).cast(plans.schema["done"].dataType).alias("done"), "role", "text", "n")
    return lines.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "piece", "at").mapInArrow(run, schema)


def _all(conversations: DataFrame, sink, schema: T.StructType, long_rows: int, long_bytes: int, piece_rows: int) -> DataFrame:
    text = F.coalesce("text", F.lit(" "))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                                text.alias("text"))
    long = stored(rows.groupBy("conv_id").agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes"))
                  .where((F.col("rows") > long_rows) | (F.col("bytes") > long_bytes)).select(F.col("conv_id").alias("_conv")), "long-turns")
    if long.isEmpty():
        return _short(rows, sink, schema)
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    return _short(rows.join(long, same, "left_anti"), sink, schema) \
        .unionByName(_long(rows.join(long, same, "left_semi"), sink, schema, piece_rows))


def audits(conversations: DataFrame, empty: DataFrame | None = None, long_rows: int = LONG_ROWS,
           long_bytes: int = LONG_BYTES, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """One row for each conversation of ``conversations`` (conv_id, turn, role, text).

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. Rows
    count in order of turn, nulls first, then role, then text. A null role or text is one space, so a
    null text is blank; a null conv_id is a conversation of its own; a role of no character, or of
    another initial than s, u and a, is never kept. Repeated rows are duplicates. An empty table gives
    an empty result; further columns are not looked at. ``empty`` (conv_id) adds conversations without
    rows: zeros, an empty audit and the hash of nothing.
    """
    schema = T.StructType([conversations.schema["conv_id"], *[T.StructField(c, T.LongType()) for c in COUNTS],
                           T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    found = _all(conversations, _digests, schema, long_rows, long_bytes, piece_rows)
    if empty is None:
        return found
    zeros = [F.lit(0).cast("long").alias(c) for c in COUNTS]
    return found.unionByName(empty.select("conv_id", *zeros, F.lit("").alias("audit"),
                                          F.lit(hashlib.sha256().hexdigest()).alias("repaired_sha256")))


def repaired(conversations: DataFrame, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES,
             piece_rows: int = PIECE_ROWS) -> DataFrame:
    """The repaired rows: conv_id, place (from 0), edit (K, R or I), role, text; cases as in :func:`audits`."""
    schema = T.StructType([conversations.schema["conv_id"], T.StructField("place", T.LongType()),
                           *[T.StructField(c, T.StringType()) for c in ("edit", "role", "text")]])
    return _all(conversations, _repaired, schema, long_rows, long_bytes, piece_rows)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with a fault in five of twenty rows, chosen by CRC-32 of ``conv_id:turn``.

    0 drops the row (alive is false), 1 empties its text, 2 removes its full stops, exclamation and
    question marks, 3 repeats it, 4 makes it the user's. Nulls are written as one space.
    """
    role, text = [F.coalesce(c, F.lit(" ")) for c in ("role", "text")]
    conv, turn = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    key = F.concat(conv, F.lit(":"), turn)
    fault = F.crc32(key.cast("binary")) % 20
    rows = conversations.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, "".join(STOPS), "")).otherwise(text).alias("text"),
        (fault != 0).alias("alive"), F.when(fault == 3, 2).otherwise(1).alias("copies"))
    return rows.select("conv_id", "turn", "role", "text", "alive", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).drop("copy")
