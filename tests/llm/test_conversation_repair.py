"""Repair of conversations against a plain search over whole conversations."""

import hashlib
import random
from itertools import pairwise, product
from zlib import crc32

import pytest

import gainledger.llm.conversation_repair as conversation_repair
from gainledger.llm.conversation_repair import COUNTS, damaged, repair_digests, repaired_turns
from gainledger.llm.queries import op11_conversation_repair
from gainledger.llm.repair_automaton import LETTERS, Automaton, read_audit

SPACES = " \t\n\x0b\x0c\r"
COLUMNS = ["gaps", *COUNTS, "cost", "audit", "repaired_sha256"]
ROWS = "conv long, turn int, role string, text string, _row string, copies string"


def damage(rows):
    """(turn, role, text) after damage, in order."""
    out = []
    for conv, turn, role, text in rows:
        named = [" " if x is None else str(x) for x in (conv, turn)]
        role, text = (" " if x is None else x for x in (role, text))
        fate = crc32(":".join(named).encode()) % 20
        if fate == 1:
            text = ""
        elif fate == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif fate == 4:
            role = "user"
        out += [(turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def fault_of(row, earlier):
    _, role, text = row
    bare = text.rstrip(SPACES)
    if not bare:
        return "blank"
    if (role, text) in earlier:
        return "duplicate"
    return "" if bare[-1] in ".!?" else "truncated"


def legal(initials):
    """Whether a string of initials is (s?(ua)+)?."""
    rest = initials[1:] if initials[:1] == "s" else initials
    return initials == "" or (rest != "" and rest == "ua" * (len(rest) // 2))


def mend(rows):
    """Cost, audit and repaired lines: the least of (cost, audit) over all edits, position by position.

    Prefixes with equal futures are merged by the initials written so far, shortened to what decides.
    """
    faults, earlier = [], set()
    for row in rows:
        faults.append(fault_of(row, earlier))
        earlier.add(row[1:])

    def shape(initials):
        """The same answers to every continuation, but short; None if no continuation is legal."""
        head, rest = (initials[:1], initials[1:]) if initials[:1] == "s" else ("", initials)
        if rest != ("ua" * len(rest))[: len(rest)]:
            return None
        return head + (rest if len(rest) < 3 else rest[: 1 + (len(rest) - 1) % 2])

    def put(into, key, value):
        if key is not None and (key not in into or value < into[key]):
            into[key] = value

    def inserted(now):
        for _ in range(2):
            for key, (cost, audit, lines) in list(now.items()):
                for role in ("user", "assistant"):
                    put(now, shape(key + role[0]), (cost + 5, audit + "I", (*lines, f"{role}:")))
        return now

    now = inserted({"": (0, "", ())})
    for (_, role, text), fault in zip(rows, faults, strict=True):
        after = {}
        for key, (cost, audit, lines) in now.items():
            put(after, key, (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            added = 5 * (fault == "truncated")
            if role[:1] in ("s", "u", "a"):
                put(after, shape(key + role[:1]), (cost + added, audit + "K", (*lines, f"{role}:{text}")))
            for other in ("user", "assistant"):
                put(after, shape(key + other[0]), (cost + added + 1, audit + "R", (*lines, f"{other}:{text}")))
        now = inserted(after)
    # Of equal cost and audit there is one repair only: every edit leads to one role.
    return min(value for key, value in now.items() if legal(key)), faults


def brute(rows):
    """conv -> its row, without the conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        left = damage([r for r in rows if r[0] == conv])
        turns = {t for t, *_ in left if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        (cost, audit, lines), faults = mend(left)
        counts = [faults.count(name) for name in ("blank", "duplicate", "truncated")]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairwise(left))
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], ROWS)


def found(rows):
    return {r.conv: tuple(r[c] for c in COLUMNS) for r in rows.select("conv", *COLUMNS).collect()}


def some_rows(seed):
    pick = random.Random(seed)
    texts = ["Yes.", "No", "", " \n", None, "What?", "Go on!  ", "…", "Yes.", "a: b\nc.", "é.\xa0", "x" * 3000 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "ubot", "System"]
    rows = []
    for conv in [*range(60), None]:
        for turn in range(pick.randrange(1, 14)):
            turn = pick.choice([turn, turn, turn, turn + 3, None, -turn, 2**31 - 1])
            rows += [(conv, turn, pick.choice(roles), pick.choice(texts))] * pick.choice([1, 1, 1, 1, 2])
    return rows


def test_every_short_conversation_is_mended_best():
    listed = sorted((("".join(x)) for n in range(5) for x in product(LETTERS, repeat=n)), key=lambda s: s[::-1])
    role_of = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}
    automaton = Automaton()
    for signature in listed:
        node = automaton.node(True, 0, signature)
        rows = [
            (k, role_of.get(x.lower(), "user"), "" if x == "x" else f"{k}" + "." * x.islower())
            for k, x in enumerate(signature)
        ]
        (cost, audit, _), _ = mend(rows)
        assert (node.costs[0], read_audit(node.audits[0])[0]) == (cost, audit), signature


@pytest.mark.parametrize("part_rows", [1, 3, 1 << 15])
def test_conversations(spark, work, monkeypatch, part_rows):
    monkeypatch.setattr(conversation_repair, "PART_ROWS", part_rows)
    rows = some_rows(part_rows)
    assert found(repair_digests(damaged(frame(spark, rows)), work)) == brute(rows)


def test_one_conversation_over_many_tasks(spark, work, monkeypatch):
    monkeypatch.setattr(conversation_repair, "PART_ROWS", 50)
    pick = random.Random(9)
    rows = [
        (7, turn, pick.choice(["user", "assistant", "system"]), pick.choice([f"{turn}.", "Again.", f"{turn}"]))
        for turn in range(1500)
    ]
    rows += [(8, 0, "user", "Hm.")]
    assert found(repair_digests(damaged(frame(spark, rows)), work)) == brute(rows)


def test_nothing_broadcast(spark, work, monkeypatch):
    for bound in ("LOOKUP_ROWS", "LOOKUP_BYTES"):
        monkeypatch.setattr(conversation_repair, bound, 0)
    monkeypatch.setattr("gainledger.llm.common.LOOKUP_ROWS", 0)
    rows = some_rows(4)
    assert found(repair_digests(damaged(frame(spark, rows)), work)) == brute(rows)


def test_dropped_conversation_is_reported(spark, work):
    conv = next(c for c in range(1000) if crc32(f"{c}:0".encode()) % 20 == 0)
    (row,) = repair_digests(damaged(frame(spark, [(conv, 0, "user", "Hello.")])), work).collect()
    assert tuple(row) == (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_no_conversations(spark, work):
    assert repair_digests(damaged(frame(spark, [])), work).count() == 0


def test_repaired_turns_read_like_their_hash(spark, work):
    rows = damaged(frame(spark, some_rows(5)))
    lines = {}
    for r in sorted(repaired_turns(rows, work).collect(), key=lambda r: (r.task, r.part, r.seat)):
        lines.setdefault(r.conv, []).append(f"{r.role}:{r.text}")
    for r in repair_digests(rows, work).collect():
        assert hashlib.sha256("\n".join(lines.get(r.conv, [])).encode()).hexdigest() == r.repaired_sha256


def test_test_data(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(op11_conversation_repair(spark, folder).withColumnRenamed("conv_id", "conv")) == brute(rows)
