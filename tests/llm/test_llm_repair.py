"""Conversation repair against all edits of short conversations and a plain search of longer ones."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from saleswh.llm import repair
from saleswh.llm.queries import QUERIES

GOAL = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        bare = (text or "").strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def searched(rows, bad):
    """(cost, audit, repaired) by relaxing all edits until nothing improves; the states are the roles said so far."""
    table = {(0, ""): (0, "", ())}

    def said(have, role):
        return {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}[have].get(role)

    n, again = len(rows), True
    while again:
        again = False
        for (i, have), (cost, audit, lines) in list(table.items()):
            steps = [((i, x), 2, "I", (f"{name}:",)) for name in ("user", "assistant") if (x := said(have, name[0]))]
            if i < n:
                _, role, text = rows[i]
                steps.append(((i + 1, have), 3, "D", ()))
                if bad[i] not in ("blank", "duplicate"):
                    cut = bad[i] == "truncated"
                    if (x := said(have, (role or "")[:1])):
                        steps.append(((i + 1, x), cut, "K", (f"{role}:{text}",)))
                    steps += [((i + 1, x), 2 + cut, "R", (f"{name}:{text}",)) for name in ("user", "assistant") if (x := said(have, name[0]))]
            for node, more, letter, line in steps:
                found = (cost + more, audit + letter, lines + line)
                if node not in table or found[:2] < table[node][:2]:
                    table[node], again = found, True
    return min(table[n, x] for x in ("", "a") if (n, x) in table)


def brute(rows):
    """Of (conv_id, turn, role, text): what the contract asks for of damaged rows."""
    out, low = [], lambda x: (x is not None, x if x is not None else 0)
    for conv in {r[0] for r in rows}:
        own = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (low(r[0]), (r[1] is not None, r[1] or ""), (r[2] is not None, (r[2] or "").encode())))
        bad, turns = faults(own), {r[0] for r in own if r[0] is not None}
        cost, audit, lines = searched(own, bad)
        letters = [(r[1] or "")[:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:]))  # noqa: B905
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, bad.count("blank"), bad.count("duplicate"), bad.count("truncated"),
                    illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def harmed(rows):
    out = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 and text is not None else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def dialogues(n, most, seed):
    g = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "No!", "Why", "", " \n", None, "Ja ", "Ends here?", "cut off", "A.\t", "é."]
    return [(g.choice([c, c, None]) if g.random() < .02 else c, g.choice([t, t, t, g.randrange(4), None]), g.choice(roles), g.choice(texts))
            for c in range(n) for t in range(g.randrange(most + 1))]


def audited(spark, rows):
    frame = spark.createDataFrame([(*r, 3, "x") for r in rows], "conv_id long, turn long, role string, text string, cost long, audit string")
    return sorted((tuple(r) for r in repair.audited(frame).collect()), key=str)


def test_cheapest_against_all_edits():
    """Every string of edits up to 7 letters that gives legal roles, for rows of every kind."""
    g = random.Random(3)
    for _ in range(60):
        n = g.randrange(4)
        letters, bad = [g.choice("suat") for _ in range(n)], [g.choice(["", "", "t", "b", "d"]) for _ in range(n)]
        best = []
        for size in range(n, n + 4):
            for edits in product("DIKR", repeat=size):
                if sum(e != "I" for e in edits) != n:
                    continue
                rows = iter(range(n))
                choices, cost = [], 0
                for e in edits:
                    i = next(rows) if e != "I" else None
                    if e in "KR" and bad[i] in ("b", "d"):
                        break
                    cost += {"K": 0, "R": 2, "D": 3, "I": 2}[e] + (e in "KR" and bad[i] == "t")
                    choices.append({"D": [""], "K": [letters[i]] if i is not None else []}.get(e, ["u", "a"]))
                else:
                    if any(GOAL.fullmatch("".join(x)) for x in product(*choices)):
                        best.append((cost, "".join(edits)))
        assert repair.cheapest(letters, bad) == min(best)


def test_equal_to_a_plain_search(spark):
    rows = dialogues(150, 9, 1)
    assert audited(spark, rows) == brute(rows)


def test_long_conversations_in_chunks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(repair, "CHUNK", 4)
    rows = dialogues(40, 30, 2) + [(77, None, "user", "Same.")] * 30 + [(78, 1, g, "Hot.") for g in ("user", "assistant")] * 20
    want = brute(rows)
    assert audited(spark, rows) == want
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parts = {}
    for r in repair.repaired(frame).collect():
        parts.setdefault(r.conv_id, []).append((r.part, [f"{m.role}:{m.text}" for m in r.messages]))
    texts = {c: "\n".join(x for _, m in sorted(p) for x in m) for c, p in parts.items()}
    assert {c: hashlib.sha256(t.encode()).hexdigest() for c, t in texts.items()} == {r[0]: r[-1] for r in want}


@pytest.mark.parametrize("rows", [[], [(1, 0, None, None)], [(None, None, "system", "S.")], [(1, 0, "user", "x" * 100_000)]])
def test_small_tables(spark, rows):
    assert audited(spark, rows) == brute(rows)


def test_the_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {r[0]: r for r in brute(harmed(rows))}
    for conv in {r[0] for r in rows} - set(want):
        want[conv] = (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = QUERIES["op13_conversation_repair"](spark, folder)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want.values(), key=str)


def test_damage(spark):
    rows = [(c, t, "assistant", "A. b! c?") for c in (1, 2, None) for t in [*range(60), None]]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted((tuple(r) for r in repair.damaged(frame).collect()), key=str) == sorted(harmed(rows), key=str)
