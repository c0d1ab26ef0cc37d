"""Repair of conversations against enumeration of all edits, a full chart, and SQL."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from areaweave.llm import conversation_repair as cr
from areaweave.llm.oracles import ORACLES
from areaweave.llm.queries import op12_conversation_repair
from workloads.check import database, differences

PATTERN = re.compile(r"(s?(ua)+)?")
SPACE = "\x20\t\n\x0b\f\r"


def every_repair(turns):
    """(cost, audit, role initials) of all ways to edit (initial, cut, must go), two insertions in a gap at most."""
    inserts = ["", "u", "a", "ua", "au"]
    per_turn = []
    for initial, cut, must_go in turns:
        ways = [(4, "D", "")]
        if not must_go:
            extra = 3 if cut else 0
            ways += [(extra, "K", initial), (3 + extra, "R", "u"), (3 + extra, "R", "a")]
        per_turn.append(ways)
    for ways in itertools.product(*per_turn):
        for gaps in itertools.product(inserts, repeat=len(turns) + 1):
            roles, audit, cost = gaps[0], "I" * len(gaps[0]), 3 * len(gaps[0])
            for (c, edit, role), gap in zip(ways, gaps[1:], strict=True):
                roles, audit, cost = roles + role + gap, audit + edit + "I" * len(gap), cost + c + 3 * len(gap)
            if PATTERN.fullmatch(roles):
                yield cost, audit, roles


def some_turn(rng):
    return rng.choice("suuuaaax"), rng.random() < 0.2, rng.random() < 0.25


def test_least_of_all_repairs():
    rng = random.Random(0)
    for n in (0, 1, 1, 2, 2, 2, 3, 3, 3, 3, 3, 3):
        turns = [some_turn(rng) for _ in range(n)]
        assert cr.cheapest(cr.parse([cr.turn_cell(*t) for t in turns])) == min(every_repair(turns))[:2]


def test_one_split_is_as_good_as_all():
    rng = random.Random(1)
    for n in (4, 7, 12, 20):
        cells = [cr.turn_cell(*some_turn(rng)) for _ in range(n)]
        chart = {(i, i + 1): cell for i, cell in enumerate(cells)}
        for length in range(2, n + 1):
            for i in range(n - length + 1):
                best = [None] * len(cr.NONTERMINALS)
                for k in range(i + 1, i + length):
                    for m, found in enumerate(cr.combine(chart[i, k], chart[k, i + length])):
                        if found is not None and (best[m] is None or found < best[m]):
                            best[m] = found
                chart[i, i + length] = best
        assert cr.parse(cells) == chart[0, n]
        stretch = cr._Stretch()
        for cell in cells:
            stretch.add("u", cell)
        assert stretch.cell() == chart[0, n]


def plain(rows, break_up=True):
    """Figures of every conversation by a search over turns and states, cheapest and least audit first."""
    damaged, ids = {}, {r[0] for r in rows}
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if break_up else 9
        role, text = " " if role is None else role, " " if text is None else text
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        damaged.setdefault(conv, []).extend([(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    for conv in ids:
        kept = sorted(damaged.get(conv, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, counts, turns = set(), [0, 0, 0], []
        for _, role, text in kept:
            blank, again, cut = not text.strip(SPACE), (role, text) in seen, text.rstrip(SPACE)[-1:] not in (".", "!", "?")
            seen.add((role, text))
            for i, fault in enumerate((blank, again, cut)):
                if fault:
                    counts[i] += 1
                    break
            turns.append((role[:1], cut, blank or again))
        numbers = {r[0] for r in kept if r[0] is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        states = {"": (0, "", ())}
        for k in range(len(turns) + 1):
            for _ in range(3):
                for state, (cost, audit, out) in list(states.items()):
                    role = "a" if state == "u" else "u"
                    way = cost + 3, audit + "I", (*out, ({"u": "user", "a": "assistant"}[role], ""))
                    if role not in states or way[:2] < states[role][:2]:
                        states[role] = way
            if k == len(turns):
                break
            (initial, cut, must_go), (_, own, text), after = turns[k], kept[k], {}
            for state, (cost, audit, out) in states.items():
                ways = [(state, cost + 4, "D", None)]
                for role in {"": "su", "s": "u", "u": "a", "a": "u"}[state]:
                    extra = cost + (3 if cut else 0)
                    if not must_go and role == initial:
                        ways.append((role, extra, "K", own))
                    if not must_go and role != "s":
                        ways.append((role, extra + 3, "R", {"u": "user", "a": "assistant"}[role]))
                for to, c, edit, shown in ways:
                    way = c, audit + edit, out if shown is None else (*out, (shown, text))
                    if to not in after or way[:2] < after[to][:2]:
                        after[to] = way
            states = after
        cost, audit, out = min(states[s] for s in ("", "a") if s in states)
        text = "\n".join(f"{r}:{t}" for r, t in out)
        yield (conv, gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def test_registered_query_as_plain_and_as_sql(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = op12_conversation_repair(spark, sf)
    assert sorted(tuple(r) for r in got.select(*COLUMNS).collect()) == sorted(plain(rows))
    assert differences(got, database(sf), ORACLES["op12_conversation_repair"]) == []


def edge_rows():
    rng = random.Random(5)
    texts = ["Yes.", "No!", "why?\n", "cut off", "", " \t", None, "ünï.", "é" * 5000 + "."]
    roles = ["user", "assistant", "system", "User", "", None, "tool", "us"]
    rows = [(c, t, rng.choice(roles[:2] if rng.random() < 0.7 else roles), rng.choice(texts))
            for c in [*range(30), None] for t in range(rng.randrange(9))]
    rows += [(100, None, "user", "a."), (100, None, "user", "a."), (100, None, "assistant", "b."), (101, 5, "user", "x."),
             (101, 1, None, None), (102, None, "assistant", "only.")]
    # One long conversation, so that several tasks share it.
    rows += [(7000, i, rng.choice(["user", "assistant"]), rng.choice(texts[:4]) or "x") for i in range(900)]
    rows += [(7001, i // 2, rng.choice(["user", "assistant"]), f"turn {rng.randrange(300)}.") for i in range(600)]
    return rows


@pytest.mark.parametrize("break_up", [True, False])
def test_edges_as_plain(spark, break_up, tmp_path):
    rows = edge_rows()
    frame = spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows],
                                  "conv_id long, turn long, role string, text string, key string, audit string, n int")
    if break_up:
        frame.write.parquet(f"{tmp_path}/conversations.parquet")
        got = op12_conversation_repair(spark, str(tmp_path))
        assert differences(got, database_of(tmp_path), ORACLES["op12_conversation_repair"]) == []
        got = got.select(*COLUMNS).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(plain(rows), key=repr)
        return
    found, turns = cr.repair(frame)
    digests = {r.key: r.repaired_sha256 for r in cr.digests(turns).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    got = [(None if r.key == " " else int(r.key), *[r[c] for c in COLUMNS[1:-1]], digests.get(r.key, nothing))
           for r in found.collect()]
    assert sorted(got, key=repr) == sorted(plain(rows, False), key=repr)


def database_of(folder):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{folder}/conversations.parquet/*.parquet')")
    return con


def test_long_conversation_is_shared_by_tasks(spark):
    rows = spark.range(3_000).selectExpr("7 as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role",
                                         "concat('t', id, '.') as text")
    entries = cr.faults(cr.turns(rows))
    order = ["key", "turn", "role", "digest"]
    sizes = [len(p) for p in entries.repartitionByRange(8, *order).rdd.glom().collect()]
    assert max(sizes) < 1_000
    [found] = cr.audits(entries).collect()
    assert (found.cost, found.audit, found.illegal) == (0, "K" * 3_000, 0)


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    found, turns = cr.repair(empty)
    assert found.count() == 0 and turns.count() == 0
    assert cr.damaged(empty).count() == 0


def test_turns_in_order(spark):
    rows = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "So?"), (1, 2, "assistant", "Yes."), (1, 3, "assistant", "No.")],
                                 "conv_id long, turn long, role string, text string")
    found, turns = cr.repair(rows)
    [r] = found.collect()
    assert (r.cost, r.audit, r.illegal) == (6, "KIKKIK", 2)  # KRRK costs as much
    turns = sorted(turns.collect(), key=lambda t: t.seq)
    assert [(t.role, t.text) for t in turns] == [("user", "Hi."), ("assistant", ""), ("user", "So?"), ("assistant", "Yes."), ("user", ""),
                                                 ("assistant", "No.")]
