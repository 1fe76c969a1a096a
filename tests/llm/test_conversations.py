"""Conversation repair against a search that tries the edits in order of cost and letters."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from assayline.llm import conversations as cv, registry

PATTERN = re.compile("(s?(ua)+)?")


def cheapest(kinds):
    """(cost, audit, roles) by trying edit strings in order of (cost, letters), no states merged.

    `kinds` are (initial, must go, truncated)."""
    heap = [(0, "", 0, "")]
    while heap:
        cost, done, k, roles = heapq.heappop(heap)
        if k == len(kinds) and PATTERN.fullmatch(roles):
            return cost, done, roles
        if k < len(kinds):
            initial, must_go, cut = kinds[k]
            heapq.heappush(heap, (cost + 3, done + "D", k + 1, roles))
            if not must_go:
                for letter, role, price in (("K", initial, 0), ("R", "u", 2), ("R", "a", 2)):
                    heapq.heappush(heap, (cost + price + cut, done + letter, k + 1, roles + (role or "?")))
        if not done.endswith("II"):
            for role in "ua":
                heapq.heappush(heap, (cost + 2, done + "I", k, roles + role))


KINDS = [(i, False, cut) for i in ("s", "u", "a", "") for cut in (False, True)] + [("u", True, False)]


def fast(kinds):
    talk = cv._Conversation("c", cv.RepairSettings())
    for initial, must_go, cut in kinds:
        fault = "blank" if must_go else "truncated" if cut else None
        talk.add(None, {"s": "system", "u": "user", "a": "assistant", "": "tool"}[initial], "x", fault)
    return talk


@pytest.mark.parametrize("length", [0, 1, 2, 3])
def test_every_short_conversation(length):
    for kinds in itertools.product(KINDS, repeat=length):
        cost, audit, roles = cheapest(kinds)
        talk = fast(kinds)
        assert talk.edits() == (cost, audit), kinds
        assert "".join(r[3][0] for r in talk.rows() if r[1]) == roles


def test_random_longer_conversations():
    draw = random.Random(3)
    for _ in range(150):
        kinds = [draw.choice(KINDS) for _ in range(draw.randint(4, 6))]
        assert fast(kinds).edits() == cheapest(kinds)[:2], kinds


def test_spilled_state_gives_the_same(monkeypatch):
    draw = random.Random(5)
    kinds = [draw.choice(KINDS) for _ in range(70_000)]
    talk, small = fast(kinds), cv._Conversation("c", cv.RepairSettings(held=1))
    for initial, must_go, cut in kinds:
        fault = "blank" if must_go else "truncated" if cut else None
        small.add(None, {"s": "system", "u": "user", "a": "assistant", "": "tool"}[initial], "x", fault)
    assert small.turns._rolled and small.back._rolled
    assert talk.edits() == small.edits()
    assert list(talk.rows()) == list(small.rows())


def plain(rows):
    """The whole contract in Python; rows are (conv_id, turn, role, text)."""
    talks = {}
    for conv, turn, role, text in rows:
        own = talks.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        what = zlib.crc32(name.encode()) % 20
        if what == 0:
            continue
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        own += [(turn, "user" if what == 4 else role, text)] * (2 if what == 3 else 1)
    out = []
    for conv, own in talks.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, kinds, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for turn, role, text in own:
            rest = re.findall("[^\x20\x09-\x0d]", text)
            fault = (
                "blank" if not rest else "duplicate" if (role, text) in seen
                else "truncated" if rest[-1] not in ".!?" else None
            )
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            initial = role[:1] if role[:1] in ("s", "u", "a") else ""
            kinds.append((initial, fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        numbers = {r[0] for r in own if r[0] is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        cost, audit, roles = cheapest(kinds)
        lines, k, at = [], 0, 0
        for edit in audit:
            if edit in "KR":
                role = own[k][1] if edit == "K" else {"u": "user", "a": "assistant"}[roles[at]]
                lines.append(f"{role}:{own[k][2]}")
            elif edit == "I":
                lines.append({"u": "user:", "a": "assistant:"}[roles[at]])
            k, at = k + (edit != "I"), at + (edit != "D")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *faults.values(), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def query(turns):
    got = cv.audit(cv.repair(cv.damaged(turns), present="present"))
    return sorted(map(tuple, got.collect()), key=repr)


def test_query_equals_the_plain_form(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    got = registry.queries()["op11_conversation_repair"](spark, sf_dir)
    assert got.columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    ]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(map(tuple, turns.collect()))


TURN_SCHEMA = "conv_id long, turn long, role string, text string"


def test_edge_rows_and_clashing_columns(spark):
    rows = [
        (None, None, None, None), (None, 3, "user", "Hi."), (None, 2**62, "assistant", "Yes."),
        (1, None, "user", "a."), (1, None, "assistant", "b!"), (1, 0, "system", "c?"),
        (2, 5, "user", ""), (2, 5, "user", ""), (2, 9, "", "x"), (2, 9, "tool", "x "),
        (3, 1, "user", "same."), (3, 2, "assistant", "ok."), (3, 3, "user", "same."), (3, 3, "user", "same."),
        (4, -(2**62), "assistant", "漢字 😀"), (2**60 + 1, 1, "user", "long. " * 50_000),
    ]
    rows += [(k, t, r, "fine.") for k in range(10, 60) for t, r in enumerate(("user", "assistant"))]
    turns = spark.createDataFrame(rows, TURN_SCHEMA).selectExpr(
        "text as seen", "role as fault", "*", "turn as position", "text as present", "role as edit"
    ).repartition(4)
    assert query(turns) == plain(rows)
    assert query(turns.limit(0)) == []


def test_conversation_across_batches_and_general_columns(spark):
    rows = [(7, k, ("user", "assistant")[k % 2], f"turn {k}.") for k in range(500)] + [(8, 0, "system", "Be kind.")]
    turns = spark.createDataFrame(rows, TURN_SCHEMA).selectExpr(
        "cast(conv_id as string) talk", "turn as nr", "role as who", "text as said"
    )
    previous = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        made = cv.repair(turns, conv_id="talk", turn="nr", role="who", text="said").cache()
        kept = cv.repaired_turns(made).where("conv_id = '7'").orderBy("position").collect()
        counts = {r.conv_id: r for r in made.where("position = 0").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", previous)
    assert [(r.role, r.text) for r in kept] == [r[2:] for r in rows[:-1]]
    assert counts["7"].cost == 0 and counts["7"].audit == "K" * 500
    assert (counts["8"].cost, counts["8"].audit) == (3, "D")
