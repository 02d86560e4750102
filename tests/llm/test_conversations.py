"""Prefix trie and structure repair against brute force."""

import hashlib
import random
import re
import zlib

import pytest

from revtide.llm import repair, trie
from revtide.llm.queries import ORACLES, QUERIES
from tests.compare import connect, difference
from tests.llm.helpers import rows

SPACES = " \t\n\v\f\r"
SCHEMA = "conv_id long, turn long, role string, text string, path string, key string, n_convs long, edit string"


@pytest.mark.parametrize("name", ["op12_prefix_trie", "op13_structure_repair"])
def test_queries_equal_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    assert difference(QUERIES[name](spark, sf).toPandas(), connect(sf).execute(ORACLES[name]).df()) is None


def odd_turns(seed=3, convs=130):
    """Nulls in every column, ties, repeated rows, shared beginnings, copies, one long conversation."""
    r = random.Random(seed)
    out = [(None, None, None, None), (5, None, None, None), (5, None, "user", "a b."), (5, 0, "user", ""), (5, 0, "user", "a b.")]
    for c in [*range(convs), 250, 333, 700]:
        for t in range(r.choice([0, 1, 2, 3, 5, 8]) if c % 7 else 4):
            said = "Hello." if t == 0 and c % 3 else r.choice(["yes.", "no", "why?", " \n", "", None, "é日本."]) if c % 7 else "same."
            out.append((c, r.choice([t, t, t, None, t + 3]) if c % 11 == 0 else t, r.choice(["user", "assistant", "system", None, "tool", "User"])
                        if c % 5 == 0 else ("user", "assistant")[t % 2], said))
    out += [out[40]] * 2 + [(9, t, "user", "again." if t % 2 else f"line {t}.") for t in range(20, 400)]
    out += [(c, None, None, None) for c in range(400, 480)]
    return out


def frame(spark, turns):
    return spark.createDataFrame([(*t, "x", "y", 1, "z") for t in turns], SCHEMA)


# --- trie -----------------------------------------------------------------

def expected_paths(turns):
    own = {}
    for c, t, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append((t is not None, t or 0, role, key, len(text)))
    own = {c: [(x[3], x[4]) for x in sorted(p)] for c, p in own.items()}
    head = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    return {c: own.get(c - c % 100, [])[:head[c]] + own[c][head[c]:] for c in own}


def expected_trie(paths):
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(k for k, _ in path[:d]), []).append(c)
    out = []
    for node, found in members.items():
        d, children = len(node), [x for x in members if len(x) == len(node) + 1 and x[:len(node)] == node]
        below = [x for x in members if x[:d] == node]
        leaves = sum(1 for x in below if not any(y[:-1] == x and y for y in below))
        chars = [paths[members[x][0]][len(x) - 1][1] if x else 0 for x in below]
        ends = ",".join(str(c) for c in sorted(c for c in found if len(paths[c]) == d))
        out.append((min(found), d, min(members[node[:-1]]) if d else None, len(found), len(children), leaves,
                    sum((len(members[x]) - 1) * n for x, n in zip(below, chars)), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("convs,turns", [(1, 10_000), (3, 10_000), (1000, 10_000), (1000, 9)])
def test_trie_equals_brute_force_at_any_shard_size(spark, monkeypatch, convs, turns):
    monkeypatch.setattr(trie, "SHARD_CONVS", convs)
    monkeypatch.setattr(trie, "SHARD_TURNS", turns)
    given = odd_turns()
    assert rows(trie.report(frame(spark, given))) == expected_trie(expected_paths(given))


def test_copies_are_spread_over_shards_and_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(trie, "SHARD_CONVS", 16)
    given = [(c, t, "user", f"turn {t}") for c in range(900) for t in range(3)] + [(c, 0, "user", "turn 0") for c in range(900, 960)]
    paths = trie.paths(frame(spark, given))
    assert trie.shards(paths).count() >= 60
    got = rows(trie.trie(paths))
    assert len(got) == 4 and got == expected_trie({r.conv_id: [(bytes(k), n) for k, n in r.path] for r in paths.collect()})


def test_trie_of_no_conversations(spark):
    assert rows(trie.report(frame(spark, []))) == []
    assert rows(trie.report(frame(spark, [(None, 1, "user", "a")]))) == []


# --- repair ---------------------------------------------------------------

NEXT = {("n", "s"): "s", ("n", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}


def plain_edits(turns):
    """(cost, audit, repaired) by keeping the least of every state, turn by turn."""
    states = {"n": (0, "", ())}

    def better(found, state, value):
        if state not in found or value < found[state]:
            found[state] = value

    def with_insertions(states):
        found = dict(states)
        for _ in range(3):
            for q, (cost, audit, out) in list(found.items()):
                for role in ("user", "assistant"):
                    if (q, role[0]) in NEXT:
                        better(found, NEXT[q, role[0]], (cost + 3, audit + "I", (*out, f"{role}:")))
        return found

    for role, text, fault in turns:
        after = {}
        for q, (cost, audit, out) in with_insertions(states).items():
            better(after, q, (cost + 4, audit + "D", out))
            if fault not in ("blank", "duplicate"):
                cut = 3 if fault == "truncated" else 0
                if (q, role[:1]) in NEXT:
                    better(after, NEXT[q, role[:1]], (cost + cut, audit + "K", (*out, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    if (q, new[0]) in NEXT:
                        better(after, NEXT[q, new[0]], (cost + cut + 3, audit + "R", (*out, f"{new}:{text}")))
        states = after
    return min(v for q, v in with_insertions(states).items() if q in "na")


def expected_repair(turns):
    """By conversation, of turns that are damaged already."""
    by_conv = {}
    for c, t, role, text in turns:
        by_conv.setdefault(c, []).append((t is not None, t or 0, " " if role is None else role, " " if text is None else text))
    out = {}
    for c, found in by_conv.items():
        found, seen, faulty = sorted(found), set(), []
        for _, _, role, text in found:
            shown = text.rstrip(SPACES)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None
            seen.add((role, text))
            faulty.append((role, text, fault))
        cost, audit, lines = plain_edits(faulty)
        numbers, n = [t for known, t, _, _ in found if known], [f for _, _, f in faulty]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(faulty, faulty[1:]))
        out[c] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, n.count("blank"), n.count("duplicate"),
                  n.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def expected_damage(turns):
    for c, t, role, text in turns:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            yield from [(c, t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def test_edits_equal_a_plain_dynamic_program():
    r = random.Random(1)
    for n in range(0, 40):
        for _ in range(30):
            turns = [(r.choice(["user", "assistant", "system", "tool", "", "ok"]), "x.", r.choice([None, None, None, "blank", "duplicate", "truncated"]))
                     for _ in range(n)]
            prices = [repair._prices(role[:1] if role[:1] in ("s", "u", "a") else "", repair.FAULTS.index(f or "")) for role, _, f in turns]
            assert repair.edits(prices) == plain_edits(turns)[1]


def test_a_long_conversation_is_repaired_in_a_spool(spark, monkeypatch):
    monkeypatch.setattr(repair, "SPOOL_BYTES", 1000)
    given = [(1, t, r, f"text {t} " + "word " * (t % 50) + "end.") for t, r in enumerate(random.Random(2).choices(["user", "assistant", "system"], k=3000))]
    got = repair.summary(repair.repair(frame(spark, given))).first()
    assert tuple(got)[1:] == expected_repair(given)[1]


def test_repair_equals_brute_force_on_odd_turns(spark):
    given = odd_turns()
    log = repair.repair(frame(spark, given))
    got = {r[0]: tuple(r)[1:] for r in repair.summary(log).collect()}
    assert got == expected_repair(given)
    lines = {}
    for r in sorted(log.collect(), key=lambda r: r.place):
        if r.role is not None:
            lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(lines.get(c, [])).encode()).hexdigest() for c in got} == {c: v[-1] for c, v in got.items()}
    for c, of_conv in lines.items():
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in of_conv))


def test_damaged_conversations_keep_their_row(spark):
    given = odd_turns()
    got = {r[0]: tuple(r)[1:] for r in repair.report(frame(spark, given)).collect()}
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    want = expected_repair(list(expected_damage(given)))
    assert got == {c: want.get(c, nothing) for c in {t[0] for t in given}}
    assert nothing in got.values() and rows(repair.report(frame(spark, []))) == []
