import hashlib
import itertools
import random

import pytest

from platewise.llm import repair
from platewise.llm.repair import END, conversation_digests, repair_conversations, run_chunk, trace_chunk

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def least_edits(turns):
    """Cheapest edits of (initial, forced, late) by trying all, least letters among equals."""
    best = {}
    stack = [(0, "", 0, "")]
    while stack:
        cost, said, at, letters = stack.pop()
        key = (at, said if len(said) < 2 else said[0].replace("u", "").replace("a", "") + said[-1], len(said) > 1)
        state = (0 if not said else "sua".index(said[-1]) + 1, at)
        if state in best and best[state] <= (cost, letters) and best[state] != (cost, letters):
            continue
        best[state] = (cost, letters)
        following = "a" if said.endswith("u") else "u"
        if cost <= 2 * len(turns) + 10 and len(letters) <= 3 * len(turns) + 3:
            stack.append((cost + 5, said + following, at, letters + "I"))
        if at < len(turns):
            initial, forced, late = turns[at]
            stack.append((cost + 2, said, at + 1, letters + "D"))
            if not forced:
                stack.append((cost + 1 + late, said + following, at + 1, letters + "R"))
                if initial == following or (initial == "s" and not said):
                    stack.append((cost + late, said + initial, at + 1, letters + "K"))
    return min(best[s] for s in ((0, len(turns)), (3, len(turns))) if s in best)


def brute(rows):
    """Audit, cost, counts and text of every conversation by trying all edits."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, turns, faults = set(), [], []
        for _, role, text in mine:
            kept = text.rstrip(WHITE)
            fault = "blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            turns.append((role[:1] if role[:1] in "uas" else "x", fault in ("blank", "duplicate"), 5 * (fault == "truncated")))
        cost, letters = least_edits(turns)
        lines, said, at = [], "", 0
        for letter in letters:
            following = "a" if said.endswith("u") else "u"
            role = {"a": "assistant", "u": "user"}[following]
            if letter == "I":
                lines.append(role + ":")
                said += following
                continue
            if letter == "K":
                lines.append(f"{mine[at][1]}:{mine[at][2]}")
                said += mine[at][1][0]
            elif letter == "R":
                lines.append(f"{role}:{mine[at][2]}")
                said += following
            at += 1
        numbers = [t for t, _, _ in mine if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, letters, digest)
    return out


def conversations(count, draw, longest):
    roles = ["system", "user", "assistant", "tool", None]
    texts = ["Yes.", "No!", "Why?", "well", " ", "", None, "tail . ", "a\nb.", "line\n"]
    rows = []
    for conv in range(count):
        for turn in range(draw.randint(1, longest)):
            role = draw.choice(roles) if draw.random() < 0.3 else ("user", "assistant")[turn % 2]
            text = draw.choice(texts) if draw.random() < 0.3 else f"turn {draw.randint(0, 99)}" + draw.choice([".", "", "?"])
            rows.append((conv, draw.choice([turn, turn, turn, None]), role, text))
    return rows


def found(repaired):
    digests = {r.conv_id: r.digest for r in conversation_digests(repaired.turns, part_bytes=20).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return {r.conv_id: (*[r[n] for n in names], digests.get(r.conv_id, empty)) for r in repaired.audits.collect()}


@pytest.mark.parametrize("bits", [12, 2, 0])
def test_against_all_edits(spark, monkeypatch, bits):
    monkeypatch.setattr(repair, "CHUNK_BITS", bits)
    draw = random.Random(bits)
    rows = conversations(40, draw, 9)
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (100, None, None, None), rows[0], rows[0]]
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA + ", chunk int, edit string").repartition(3)
    repaired = repair_conversations(docs)
    assert found(repaired) == brute(rows)
    assert (repaired.passes > 0) == (bits < 12)


def test_chunks_give_what_one_run_gives():
    draw = random.Random(5)
    for _ in range(200):
        codes = [draw.randrange(12) for _ in range(draw.randint(1, 40))]
        forced = [c % 3 == 2 or draw.random() < 0.2 for c in codes]
        vectors = run_chunk(codes, forced, list(END))
        _, letters = trace_chunk(codes, forced, vectors, 0, True)
        cut = draw.randint(0, len(codes))
        left = run_chunk(codes[:cut], forced[:cut], vectors[cut])
        assert left == vectors[: cut + 1]
        state, begin = trace_chunk(codes[:cut], forced[:cut], left, 0, False)
        assert begin + trace_chunk(codes[cut:], forced[cut:], vectors[cut:], state, True)[1] == letters


def test_one_long_conversation_in_many_chunks(spark, monkeypatch):
    draw = random.Random(9)
    rows = [(c, t, r, f"{t} {x}" if x and x.strip() else x) for c, t, r, x in conversations(1, draw, 2) for _ in [0]]
    rows = [(1, t, draw.choice(["user", "assistant", "system", "tool"]), draw.choice([f"word {t}.", f"word {t}", "again.", ""])) for t in range(900)]
    rows += [(2, t, "user", "the same.") for t in range(500)] + [(3, 0, "system", "x" * 200_000 + ".")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    whole = found(repair_conversations(frame))
    monkeypatch.setattr(repair, "CHUNK_BITS", 4)
    cut = repair_conversations(frame)
    assert found(cut) == whole
    # Fewer passes than the 57 chunks.
    assert 0 < cut.passes < 30
    # Of a conversation of copies one turn is left, or none.
    assert whole[2][2] == 499
    lines = [r for r in cut.turns.filter("conv_id = 1").orderBy("chunk", "place").collect()]
    said = "".join(r.role[0] for r in lines).removeprefix("s")
    assert said == "ua" * (len(said) // 2)
    assert "".join(r.edit for r in lines) == whole[1][6].replace("D", "")


def test_empty_table(spark):
    repaired = repair_conversations(spark.createDataFrame([], SCHEMA))
    assert repaired.audits.count() == 0 and repaired.turns.count() == 0
    assert conversation_digests(repaired.turns).count() == 0
