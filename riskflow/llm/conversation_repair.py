"""Conversation structure repair by Knuth's lightest-derivation agenda.

A conversation's rows, ordered by (turn with nulls first, role, text), are repaired to
the role grammar ``(s?(ua)+)?`` by edits with costs: Keep 0, Rerole to user or
assistant 2, Delete 3 (the only edit of a blank or repeated row), Insert an empty
user or assistant row 2; a truncated row that is not deleted adds 1.

Items are repairs of the first i rows that end in a grammar state. A deduction
joins an item with an edit; its value is (cost, audit), where the audit is the
edits' initials in order. Values are compared by cost, then as ASCII text.
Deductions never lower a value and keep the order of values: two audits of the
same rows at the same cost are never each other's prefix, because the longer
one would have paid for its further Inserts. So (Knuth, 1977) an item popped
from the agenda is final, and the search ends when a goal item is popped.

Long conversations are cut into spans. A span's items are taken from every entry
state to every exit state, and spans are joined like items: the lightest of two
neighbours over the state between them.

Rows are dealt by range over (conv_id, turn, role, text), so that a conversation
with a large share of all rows spreads over many tasks; equal rows of a batch are
counted before the shuffle. A task repairs the conversations that lie within its range
as they stream by. The first and last one may go on in other tasks: their rows are
written, repeated rows found by a joined minimum, spans solved in chunks, joined per
conversation, and the repaired texts made in chunks again. Only the digest of a
repaired text and its audit, one letter a row, need one task per conversation; both
stream in order, and no task holds a long conversation's texts.

Defined cases: a null conv_id is a conversation; a null role or text is one space; an
empty role has no initial; rows that tie on turn are ordered by role and text. A
conversation without rows after damage has zeros, an empty audit and the
digest of the empty text. Empty tables give no rows, other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import heapq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm._tables import passing_tables, saved, table

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1  # costs
SPAN = 256  # rows of one agenda
CHUNK = 2048  # rows of a chunk of a border conversation
HELD_ROWS, HELD_CHARS = 20_000, 8 << 20  # of a conversation before it counts as a border one
STATES = range(4)  # nothing yet, after the system row, after a user row, after an assistant row
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ENDS = (0, 3)
LEGAL = ("su", "ua", "au")
SPACE = " \t\n\x0b\x0c\r"
ROLE = {"u": "user", "a": "assistant"}

COUNTS = ("rows", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high")
RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


# ---- the agenda ---------------------------------------------------------------

def deductions(classes: str, i: int, state: int):
    """(cost, letter, rows consumed, next state) of each edit that extends an item.

    A row's class is its initial, upper-case if truncated; ``.`` any other initial,
    ``:`` the same truncated; ``x`` must go.
    """
    for role in "ua":
        if role in NEXT[state]:
            yield INSERT, "I", 0, NEXT[state][role]
    if i < len(classes):
        c = classes[i]
        yield DELETE, "D", 1, state
        if c != "x":
            more = TRUNCATED if c.isupper() or c == ":" else 0
            if c.lower() in NEXT[state]:
                yield more, "K", 1, NEXT[state][c.lower()]
            for role in "ua":
                if role in NEXT[state]:
                    yield REROLE + more, "R", 1, NEXT[state][role]


def agenda(classes: str, start: int, whole: bool):
    """The lightest (cost, audit) over the rows from ``start`` to each state; if ``whole``, only to the first end state."""
    heap, final, out = [(0, "", 0, start)], set(), {}
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in final:
            continue
        final.add((i, state))
        if i == len(classes):
            out[state] = cost, audit
            if whole and state in ENDS:
                return out
        for more, letter, rows, then in deductions(classes, i, state):
            if (i + rows, then) not in final:
                heapq.heappush(heap, (cost + more, audit + letter, i + rows, then))
    return out


@functools.lru_cache(1 << 12)
def short_repair(classes: str):
    out = agenda(classes, 0, True)
    return min(out[q] for q in ENDS if q in out)


@functools.lru_cache(1 << 10)
def span(classes: str) -> dict:
    """(entry, exit) -> (cost, audit)."""
    return {(a, b): v for a in STATES for b, v in agenda(classes, a, False).items()}


def joined(left: dict, right: dict):
    """The lightest values of two neighbouring spans together, and the state between them of each."""
    out, mid = {}, {}
    for (a, m), (c1, t1) in left.items():
        for b in STATES:
            if (m, b) in right:
                c2, t2 = right[m, b]
                old = out.get((a, b))
                if old is None or c1 + c2 <= old[0]:
                    value = c1 + c2, t1 + t2
                    if old is None or value < old:
                        out[a, b], mid[a, b] = value, m
    return out, mid


def fold(spans: list[dict]):
    """The spans' values together, and each level's states between its neighbours (a balanced tree)."""
    levels = []
    while len(spans) > 1:
        pairs = [joined(*spans[i:i + 2]) for i in range(0, len(spans) - 1, 2)]
        levels.append([m for _, m in pairs])
        spans = [v for v, _ in pairs] + spans[len(pairs) * 2:]
    return spans[0], levels


def ways(levels: list, n: int, first: int, last: int) -> list[tuple[int, int]]:
    """(entry, exit) of each of the ``n`` spans on the lightest way from ``first`` to ``last``."""
    way = [(first, last)]
    for mids in reversed(levels):
        out = []
        for i, (a, b) in enumerate(way):
            out += [(a, mids[i][a, b]), (mids[i][a, b], b)] if i < len(mids) else [(a, b)]
        way = out
    assert len(way) == n
    return way


def spans_of(classes: str) -> list[dict]:
    return [span(classes[i:i + SPAN]) for i in range(0, len(classes), SPAN)]


def repair(classes: str) -> tuple[int, str]:
    """The lightest (cost, audit) of a whole conversation."""
    if len(classes) <= SPAN:
        return short_repair(classes)
    values, _ = fold(spans_of(classes))
    return min(values[0, q] for q in ENDS if (0, q) in values)


def repaired_lines(rows, audit: str, state: int = 0):
    """The repaired rows as ``role:text``; ``rows`` gives (role, text, copies)."""
    each = ((role, text) for role, text, copies in rows for _ in range(copies))
    for letter in audit:
        if letter == "D":
            next(each)
            continue
        role, text = (None, "") if letter == "I" else next(each)
        initial = role[:1] if letter == "K" else "a" if state == 2 else "u"
        state = NEXT[state][initial]
        yield f"{role if letter == 'K' else ROLE[initial]}:{text}"


class Tally:
    """Faults, turns and row classes of rows in order."""

    def __init__(self):
        self.n = dict.fromkeys(COUNTS, 0) | {"low": None, "high": None}
        self.classes, self.first, self.last, self.turn = [], None, None, None

    def add(self, turn, role: str, text: str, copies: int, seen: bool) -> None:
        n, initial = self.n, role[:1]
        if self.last is None:
            self.first = initial
        else:
            n["illegal"] += self.last + initial not in LEGAL
        self.last = initial
        n["illegal"] += copies - 1
        if turn is not None:
            n["turns"] += turn != self.turn
            n["low"] = turn if n["low"] is None else n["low"]
            n["high"] = self.turn = turn
        n["rows"] += copies
        end = text.rstrip(SPACE)
        if not end:
            n["blank"] += copies
            self.classes.append("x" * copies)
            return
        n["duplicate"] += copies - (not seen)
        if not seen:
            cut = end[-1] not in ".!?"
            n["truncated"] += cut
            c = initial if initial and initial in "sua" else "."
            self.classes.append((":" if c == "." else c.upper()) if cut else c)
            copies -= 1
        self.classes.append("x" * copies)

    def more(self, other: dict) -> None:
        """The counts of rows that follow (a piece's row)."""
        n = self.n
        if not other["rows"]:
            return
        if self.last is not None:
            n["illegal"] += self.last + other["first"] not in LEGAL
        self.last = other["last"]
        for c in ("rows", "blank", "duplicate", "truncated", "illegal", "turns"):
            n[c] += other[c]
        if other["low"] is not None:
            n["turns"] -= other["low"] == n["high"]
            n["low"] = other["low"] if n["low"] is None else n["low"]
            n["high"] = other["high"]

    def result(self, cost: int, audit: str, digest: str | None) -> tuple:
        n = self.n
        gaps = 0 if n["low"] is None else n["high"] - n["low"] + 1 - n["turns"]
        return gaps, n["blank"], n["duplicate"], n["truncated"], n["illegal"], cost, audit, digest


# ---- tasks ----------------------------------------------------------------------

def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _rows(batches, columns):
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


def _counted(batches):
    """Equal rows of a batch as one row with their number."""
    for batch in batches:
        if batch.num_rows:
            t = pa.Table.from_batches([batch]).group_by(["conv_id", "turn", "role", "text"]).aggregate([("copies", "sum")])
            yield from t.rename_columns(["conv_id", "turn", "role", "text", "copies"]).combine_chunks().to_batches()


def _complete(rows: list[tuple]) -> tuple:
    """The result of a whole conversation's rows (turn, role, text, copies)."""
    tally, seen, live = Tally(), set(), []
    for turn, role, text, copies in rows:
        if copies:
            tally.add(turn, role, text, copies, (role, text) in seen)
            seen.add((role, text))
            live.append((role, text, copies))
    cost, audit = repair("".join(tally.classes))
    text = "\n".join(repaired_lines(live, audit))
    return tally.result(cost, audit, hashlib.sha256(text.encode()).hexdigest())


def _in_order(id_type: pa.DataType):
    """Results of the conversations within a sorted range; rows of the first and the last one as they are."""
    long, text = pa.int64(), pa.string()
    names = ["conv_id", "part", "pos", "turn", "role", "text", "copies", *(c.split()[0] for c in RESULT.split(", "))]
    kinds = [id_type, pa.int32(), long, long, text, text, long, *([long] * 6), text, text]
    schema = pa.schema(list(zip([f"b_{n}" if n == "text" else n for n in names], kinds)))

    def run(batches):
        out, pos, now, held, chars, border, first, part = [], 0, None, [], 0, False, True, None
        no_result, no_row = (None,) * 8, (None,) * 6

        def as_rows():
            nonlocal pos, held, chars
            for turn, role, text, copies in held:
                out.append((now, part, pos, turn, role, text, copies, *no_result))
                pos += 1
            held, chars = [], 0

        started = False
        for conv, part, turn, role, text, copies in _rows(batches, ("conv_id", "part", "turn", "role", "text", "copies")):
            if started and conv != now:
                if border:
                    as_rows()
                else:
                    out.append((now, *no_row, *_complete(held)))
                    held, chars = [], 0
                first = border = False
            if not started or conv != now:
                border = first
            started, now = True, conv
            held.append((turn, role, text, copies))
            chars += len(text)
            border = border or len(held) > HELD_ROWS or chars > HELD_CHARS
            if border and (len(held) >= 256 or chars > 1 << 20):
                as_rows()
            if len(out) >= 1024 or chars > 1 << 20 and out:
                yield _batch(out, schema)
                out = []
        as_rows()
        if out:
            yield _batch(out, schema)
    return run, schema


PIECE = [("rows", "bigint"), ("blank", "bigint"), ("duplicate", "bigint"), ("truncated", "bigint"), ("illegal", "bigint"),
         ("turns", "bigint"), ("low", "bigint"), ("high", "bigint"), ("first", "string"), ("last", "string"),
         ("enter", "array<int>"), ("leave", "array<int>"), ("costs", "array<bigint>"), ("audits", "array<string>")]


def _in_chunk(tab: pa.Table) -> list[tuple]:
    """A chunk's rows (turn, role, text, copies, seen) in order."""
    rows = sorted(_rows(tab.to_batches(), ("pos", "turn", "role", "b_text", "copies", "seen")), key=lambda r: r[0])
    return [r[1:] for r in rows]


def _solve(key, tab):
    """A chunk's counts, and its lightest (cost, audit) between all states."""
    tally = Tally()
    for row in _in_chunk(tab):
        tally.add(*row)
    values, _ = fold(spans_of("".join(tally.classes)))
    ends = sorted(values)
    row = [k.as_py() for k in key] + [tally.n[c] for c in COUNTS] + [
        tally.first, tally.last, [a for a, _ in ends], [b for _, b in ends], [values[e][0] for e in ends], [values[e][1] for e in ends]]
    long, text, ints = pa.int64(), pa.string(), pa.list_(pa.int32())
    kinds = [k.type for k in key] + [long] * 8 + [text, text, ints, ints, pa.list_(long), pa.list_(text)]
    return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], ["conv_id", "part", "chunk", *(n for n, _ in PIECE)])


def _join_pieces(schema: pa.Schema):
    """For each conversation of sorted chunks: each chunk's part of the audit and entry state, and a row of totals."""
    def of(conv, pieces):
        values, levels = fold([{(a, b): (c, t) for a, b, c, t in zip(p["enter"], p["leave"], p["costs"], p["audits"])} for p in pieces])
        (cost, audit), last = min((values[0, q], q) for q in ENDS if (0, q) in values)
        tally = Tally()
        for p, (a, b) in zip(pieces, ways(levels, len(pieces), 0, last)):
            tally.more(p)
            i = next(i for i, e in enumerate(zip(p["enter"], p["leave"])) if e == (a, b))
            yield (conv, p["part"], p["chunk"], a, p["audits"][i], *([None] * 6))
        yield (conv, None, None, None, audit, *tally.result(cost, audit, None)[:6])

    def run(batches):
        names, now, pieces, started = ["conv_id", "part", "chunk", *(n for n, _ in PIECE)], None, [], False
        for row in _rows(batches, names):
            p = dict(zip(names, row))
            if started and p["conv_id"] != now:
                for out in of(now, pieces):
                    yield _batch([out], schema)
                pieces = []
            started, now = True, p["conv_id"]
            pieces.append(p)
        if pieces:
            for out in of(now, pieces):
                yield _batch([out], schema)
    return run


def _apply(key, rows, way):
    """A chunk's repaired lines."""
    out = []
    for _, _, _, state, audit, *_ in _rows(way.to_batches(), ("conv_id", "part", "chunk", "state", "audit")):
        out = list(repaired_lines([(r[1], r[2], r[3]) for r in _in_chunk(rows)], audit, state))
    return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(
        [*(k.as_py() for k in key), len(out), "\n".join(out)], [*(k.type for k in key), pa.int64(), pa.string()])],
        ["conv_id", "part", "chunk", "lines", "repaired"])


def _digest(schema: pa.Schema):
    """sha256 of the chunks' lines of each conversation, in order."""
    def run(batches):
        now, sha, lines, started = None, None, 0, False
        for conv, n, text in _rows(batches, ("conv_id", "lines", "repaired")):
            if not started or conv != now:
                if started:
                    yield _batch([(now, sha.hexdigest())], schema)
                started, now, sha, lines = True, conv, hashlib.sha256(), 0
            if n:
                sha.update(("\n" if lines else "").encode() + text.encode())
                lines += n
        if started:
            yield _batch([(now, sha.hexdigest())], schema)
    return run


# ---- DataFrames -------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): faults put in by crc32(`conv_id:turn`) % 20; a dropped row has 0 copies and no text.

    0 drops a row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes its role user.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    act = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(act.isin(0, 1), "").when(act == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    role = F.when(act == 0, "").when(act == 4, "user").otherwise(spaced("role"))
    return conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"),
                                F.when(act == 0, 0).when(act == 3, 2).otherwise(1).cast("bigint").alias("copies"))


def _arrow(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(df.schema[column].dataType)


def repaired(rows: DataFrame) -> DataFrame:
    """One row per conv_id of ``rows`` (conv_id, turn, role, text, copies; none null but conv_id and turn): faults, cost, audit, digest."""
    rows = rows.select("conv_id", "turn", "role", "text", "copies")
    id_type, id_sql = _arrow(rows, "conv_id"), rows.schema["conv_id"].dataType.simpleString()
    counted = rows.mapInArrow(_counted, rows.schema)
    order = ["conv_id", "turn", "role", "text"]
    dealt = counted.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 256)).sortWithinPartitions(*order)
    run, _ = _in_order(id_type)
    seen = dealt.withColumn("part", F.spark_partition_id()).mapInArrow(
        run, f"conv_id {id_sql}, part int, pos bigint, turn bigint, role string, b_text string, copies bigint, {RESULT}")
    spark = rows.sparkSession
    results = [c.split()[0] for c in RESULT.split(", ")]
    seen = saved(seen, "repairs", keep=True)
    done = seen.filter("part IS NULL").select("conv_id", *results)

    with passing_tables(spark):
        border = seen.filter("part IS NOT NULL").select("conv_id", "part", "pos", "turn", "role", "b_text", "copies")
        same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "b_text"), 256)
        live = border.filter("copies > 0").withColumn("same", same).withColumn("place", F.struct("part", "pos"))
        firsts = live.groupBy(F.col("conv_id").alias("of"), F.col("same").alias("key")).agg(F.min("place").alias("least"))
        live = live.join(firsts, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("same") == F.col("key")))
        live = live.withColumn("seen", F.col("place") != F.col("least")).withColumn("chunk", F.floor(F.col("pos") / CHUNK))
        live = saved(live.select("conv_id", "part", "chunk", "pos", "turn", "role", "b_text", "copies", "seen"), "border")
        key = ["conv_id", "part", "chunk"]
        types = f"conv_id {id_sql}, part int, chunk bigint, "
        pieces = saved(live.groupBy(*key).applyInArrow(_solve, types + ", ".join(f"`{n}` {t}" for n, t in PIECE)), "pieces")
        long = pa.int64()
        way = pa.schema([("conv_id", id_type), ("part", pa.int32()), ("chunk", long), ("state", pa.int32()), ("audit", pa.string()),
                         *((c, long) for c in results[:6])])
        joined_sql = types + "state int, audit string, " + ", ".join(f"{c} bigint" for c in results[:6])
        along = saved(pieces.repartition("conv_id").sortWithinPartitions(*key).mapInArrow(_join_pieces(way), joined_sql), "ways")
        lines = live.groupBy(*key).cogroup(along.filter("part IS NOT NULL").groupBy(*key)).applyInArrow(
            _apply, types + "lines bigint, repaired string")
        sha = lines.repartition("conv_id").sortWithinPartitions(*key).mapInArrow(
            _digest(pa.schema([("of", id_type), ("sha", pa.string())])), f"of {id_sql}, sha string")
        totals = along.filter("part IS NULL").join(sha, F.col("conv_id").eqNullSafe(F.col("of"))).select(
            F.col("conv_id").alias("whose"), *results[:6], "audit", F.col("sha").alias("repaired_sha256"))
        ids = border.select("conv_id").distinct()
        nothing = hashlib.sha256(b"").hexdigest()
        rest = ids.join(totals, F.col("conv_id").eqNullSafe(F.col("whose")), "left").select(
            "conv_id", *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in results[:6]),
            F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
        rest = saved(rest, "border-results", keep=True)
    return done.unionByName(rest)


def op12_conversation_repair(spark, sf_dir: str) -> DataFrame:
    return repaired(damaged(table(spark, sf_dir, "conversations")))
