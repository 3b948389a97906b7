"""Conversation repair against an exhaustive search in plain Python."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from tests.llm.conftest import by_id
from tidemark.llm import conversations as C
from tidemark.llm.storage import table

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
AFTER = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "p", ("p", "u"): "u"}
NAMES = {"u": "user", "a": "assistant"}
COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def cheapest(rows, merge):
    """Best (cost, audit) by search over all edits; rows are (initial, fault). ``merge``: each state once."""
    todo, seen = [(0, "", 0, "0", ())], set()
    while True:
        cost, audit, i, state, out = heapq.heappop(todo)
        if i == len(rows) and state in "0p":
            return cost, audit, out
        if merge and (i, state) in seen:
            continue
        seen.add((i, state))
        for r in "ua":
            if (state, r) in AFTER and not (not merge and audit.endswith("III")):
                heapq.heappush(todo, (cost + 2, audit + "I", i, AFTER[state, r], (*out, (None, r))))
        if i == len(rows):
            continue
        initial, fault = rows[i]
        heapq.heappush(todo, (cost + 3, audit + "D", i + 1, state, out))
        if fault not in ("blank", "duplicate"):
            more = fault == "truncated"
            if (state, initial) in AFTER:
                heapq.heappush(todo, (cost + more, audit + "K", i + 1, AFTER[state, initial], (*out, (i, None))))
            for r in "ua":
                if (state, r) in AFTER:
                    heapq.heappush(todo, (cost + 2 + more, audit + "R", i + 1, AFTER[state, r], (*out, (i, r))))


def brute(rows, merge=True):
    convs = {}
    for conv, turn, role, text in rows:
        lines = convs.setdefault(conv, [])
        shown = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", shown(text)) if kind == 2 else shown(text)
        lines += [(turn, "user" if kind == 4 else shown(role), text)] * (2 if kind == 3 else 1)
    found = {}
    for conv, lines in convs.items():
        lines.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, seen = [], set()
        for _, role, text in lines:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[:1] for _, r, _ in lines]
        turns = {t for t, _, _ in lines if t is not None}
        cost, audit, out = cheapest(list(zip(initials, faults)), merge)
        said = "\n".join(f"{NAMES[r] if r else lines[i][1]}:{'' if i is None else lines[i][2]}" for i, r in out)
        found[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in C.FAULTS[1:]),
                       sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                       hashlib.sha256(said.encode()).hexdigest())
    return found


def check(spark, rows, merge=True):
    got = by_id(C.of_conversations(spark.createDataFrame(rows, SCHEMA)), "conv_id")
    assert {c: tuple(r[k] for k in COLUMNS) for c, r in got.items()} == brute(rows, merge)


def conversation(rng, conv, size):
    texts = ["Yes.", "No!", "why", "", " \n", "Well. ", "x.\x0b", "née", None, "a.\x00"]
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    return [(conv, rng.choice([None, k, k, k, k + 1, k * 3]), rng.choice(roles[:2] * 4 + roles), rng.choice(texts)) for k in range(size)]


def test_short_conversations_equal_an_exhaustive_search(spark):
    rng = random.Random(5)
    check(spark, [r for c in range(150) for r in conversation(rng, c, rng.randrange(1, 6))], merge=False)


def test_longer_conversations(spark):
    rng = random.Random(6)
    check(spark, [r for c in range(60) for r in conversation(rng, c, rng.randrange(1, 60))])


def test_one_conversation_over_all_tasks(spark):
    """A conversation that range bounds cut into segments, identical rows, and null ids."""
    rng = random.Random(7)
    hot = [(7, k, rng.choice(["user", "assistant", "assistant", "system"]), f"t{rng.randrange(700)}{rng.choice('.!?,')}") for k in range(9000)]
    check(spark, [*hot, *[(7, 3, "user", "same.")] * 2000, *[(None, k, "user", "x.") for k in range(40)], (1, 1, "user", "a."), (9, 2, "assistant", "b.")])


def test_whole_table(spark):
    conversations = table(spark, "/root/testdata/sf0.01", "conversations")
    rows = [tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()]
    got = by_id(C.of_conversations(conversations), "conv_id")
    assert {c: tuple(r[k] for k in COLUMNS) for c, r in got.items()} == brute(rows)


def test_repaired_rows_follow_the_grammar(spark):
    rng = random.Random(8)
    rows = [r for c in range(80) for r in conversation(rng, c, rng.randrange(1, 20))]
    found, repaired = C.repair(spark.createDataFrame(rows, SCHEMA))
    roles = {}
    for r in repaired.collect():
        roles[r["conv_id"]] = roles.get(r["conv_id"], "") + r["role"][0]
        assert (r["edit"] == "I") == (r["turn"] is None and r["text"] == "") or r["edit"] == "K"
    assert all(re.fullmatch("(s?(ua)+)?", roles.get(r["conv_id"], "")) for r in found.collect())


def test_empty_table_and_clashing_columns(spark):
    assert C.of_conversations(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (2, 0, "user", "x")]
    plain = spark.createDataFrame(rows, SCHEMA)
    clash = plain.selectExpr("*", *[f"'x' {c}" for c in ("n", "fault", "audit", "part", "kind", "sha", "cost", "__sha", "first")])
    want = sorted(map(tuple, C.of_conversations(plain).collect()))
    assert sorted(map(tuple, C.of_conversations(clash).collect())) == want


@pytest.mark.parametrize("chunk", [1, 3])
def test_audits_kept_in_pieces(monkeypatch, chunk):
    monkeypatch.setattr(C, "CHUNK", chunk)
    rng = random.Random(chunk)
    for _ in range(300):
        rows = [(rng.choice("suaxx"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(9))]
        parse = C.Parse()
        for row in rows:
            parse.row(*row)
        want = cheapest([(i, C.FAULTS[f]) for i, f in rows], True)
        assert parse.whole() == want[:2]
        cut = rng.randrange(len(rows) + 1)
        segments = []
        for part in (rows[:cut], rows[cut:]):
            parses = {top: C.Parse(top) for top in C.TOPS}
            for row in part:
                for p in parses.values():
                    p.row(*row)
            segments.append([(top, *r) for top, p in parses.items() for r in p.results()])
        assert C.joined(segments) == want[:2]
