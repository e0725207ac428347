import hashlib
import random
import re
import zlib

import pytest

from riskflow.llm import conversation_repair as cr
from riskflow.llm.conversation_repair import damaged, repair, repaired

SPACES = " \t\n\x0b\x0c\r"


def damage(rows):
    """(conv_id, turn, role, text) after damage, in order, by conversation."""
    out = {}
    for c, t, role, text in rows:
        s = lambda x: " " if x is None else str(x)
        act = zlib.crc32(f"{s(c)}:{s(t)}".encode()) % 20
        role, text = s(role), s(text)
        of = out.setdefault(c, [])
        if act == 0:
            continue
        text = "" if act == 1 else re.sub("[.!?]", "", text) if act == 2 else text
        of += [(t, "user" if act == 4 else role, text)] * (2 if act == 3 else 1)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return {c: sorted(of, key=key) for c, of in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        if not text.strip(SPACES):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if text.rstrip(SPACES)[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, kinds):
    """Every edit sequence within a bound on the cost, the cheapest and ASCII-least one with its lines."""
    best = [3 * len(rows) + 3, "~", None]

    def go(i, ends, cost, audit, lines):
        if cost > best[0]:
            return
        roles = "".join(x[:1] if x[:1] in "sua" and x[:1] else "?" for x in ends)
        if not re.fullmatch("s?(ua)*u?", roles):
            return
        if i == len(rows):
            if re.fullmatch("(s?(ua)+)?", roles) and (cost, audit) < (best[0], best[1]):
                best[:] = [cost, audit, lines]
        else:
            _, role, text = rows[i]
            go(i + 1, ends, cost + 3, audit + "D", lines)
            if kinds[i] not in ("blank", "duplicate"):
                more = kinds[i] == "truncated"
                go(i + 1, ends + [role], cost + more, audit + "K", lines + [f"{role}:{text}"])
                for new in ("user", "assistant"):
                    go(i + 1, ends + [new], cost + 2 + more, audit + "R", lines + [f"{new}:{text}"])
        for new in ("user", "assistant"):
            go(i, ends + [new], cost + 2, audit + "I", lines + [f"{new}:"])

    go(0, [], 0, "", [])
    return best


def brute(rows):
    out = []
    for c, of in damage(rows).items():
        kinds = faults(of)
        cost, audit, lines = cheapest(of, kinds) if of else (0, "", [])
        turns = [t for t, _, _ in of if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(of, of[1:]))
        out.append((c, gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed, n=150, longest=7):
    rng, rows = random.Random(seed), []
    for c in range(n):
        for t in range(rng.randint(1, longest)):
            if rng.random() < 0.9:
                role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else "assistant" if t % 2 else "user"
                role = rng.choice(["system", "tool", "", None, "unknown"]) if rng.random() < 0.15 else role
                text = rng.choice([f"Question {t}?", "Yes.", "yes", "Fine! \n", "é. ü", None, "", " \t", f"cut off {t}", " ", "x" * 3000])
                rows.append((c, None if rng.random() < 0.05 else t * rng.choice([1, 1, 2]), role, text))
    return rows


def table(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    return df.selectExpr("*", "1 AS copies", "'x' AS part", "2 AS cost") if extra else df


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("held", [20_000, 0])
def test_equals_every_edit_sequence(spark, monkeypatch, held):
    monkeypatch.setattr(cr, "HELD_ROWS", held)  # 0: every conversation goes the way of the border ones
    monkeypatch.setattr(cr, "CHUNK", 3)
    rows = conversations(1) + [(None, 1, "user", "Hi."), (None, None, None, None), (10**9, 5, "user", "Only."), (-4, None, "system", "s.")]
    assert got(repaired(damaged(table(spark, rows, extra=True)))) == brute(rows)


def test_rows_that_are_all_dropped(spark):
    gone = [(c, 1, "user", "Hello.") for c in range(400) if zlib.crc32(f"{c}:1".encode()) % 20 == 0]
    assert len(gone) > 5
    empty = hashlib.sha256(b"").hexdigest()
    assert got(repaired(damaged(table(spark, gone)))) == sorted(((c, 0, 0, 0, 0, 0, 0, "", empty) for c, *_ in gone), key=str)
    nothing = repaired(damaged(table(spark, [])))
    assert nothing.count() == 0 and nothing.columns[-2:] == ["audit", "repaired_sha256"]


def test_spans_joined_equal_one_agenda(monkeypatch):
    rng = random.Random(5)
    for n in (0, 1, 2, 9, 10, 63, 200):
        classes = "".join(rng.choices("uaUAsS.:x", weights=[9, 9, 2, 2, 1, 1, 1, 1, 3], k=n))
        out = cr.agenda(classes, 0, False)
        want = min(out[q] for q in cr.ENDS if q in out)
        monkeypatch.setattr(cr, "SPAN", 7)
        assert repair(classes) == want
        monkeypatch.undo()
        assert repair(classes) == want


def test_hot_conversation_spreads_and_equals_the_plain_way(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(7, t, "assistant" if t % 2 else "user", rng.choice(["Thanks.", f"Say {t}!", f"cut {t}", "Thanks."])) for t in range(5000)]
    rows += [(7, 77, "user", "Thanks.")] * 900  # one repeated row
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"Part {c}.") for c in range(300) for t in range(3)]
    df = damaged(table(spark, rows).repartition(6))
    one = got(repaired(df))
    monkeypatch.setattr(cr, "HELD_ROWS", 100)
    monkeypatch.setattr(cr, "CHUNK", 512)
    assert got(repaired(df)) == one
    of = damage(rows)[7]
    classes, sevens = cr.Tally(), [r for r in one if r[0] == 7]
    seen = set()
    for t, role, text in of:
        classes.add(t, role, text, 1, (role, text) in seen)
        seen.add((role, text))
    out = cr.agenda("".join(classes.classes), 0, False)
    cost, audit = min(out[q] for q in cr.ENDS if q in out)
    lines = "\n".join(cr.repaired_lines([(r, x, 1) for _, r, x in of], audit))
    assert [r[6:] for r in sevens] == [(cost, audit, hashlib.sha256(lines.encode()).hexdigest())]
    assert sevens[0][3] == faults(of).count("duplicate")
