"""Conversation repair against all sequences of edits."""

import functools
import hashlib
import random
import re
import zlib

import pytest

from tallyframe.llm import dialogue
from tallyframe.llm.dialogue import Costs

SCHEMA = "conv_id long, turn long, role string, text string"
GOOD = re.compile(r"(s?(ua)+)?")


def cheapest(rows, costs, most=3):
    """(cost, audit, repaired) of the best edits of rows (role, text, must go, truncated), at most ``most`` turns inserted:
    all ways are tried from the last row on, as text."""

    @functools.cache
    def rest(i, last, room):
        ways = [(0, "", ())] if i == len(rows) and last in "oa" else []

        def go(cost, letter, turn, i, room):
            to = turn[0][:1] if turn else last
            if turn and to not in {"o": "su", "s": "u", "u": "a", "a": "u"}[last]:
                return
            after = rest(i, to, room)
            if after:
                ways.append((cost + after[0], letter + after[1], ((turn,) if turn else ()) + after[2]))

        for role in ("user", "assistant"):
            if room:
                go(costs.insert, "I", (role, ""), i, room - 1)
            if i < len(rows) and not rows[i][2]:
                go(costs.rerole + costs.truncated * rows[i][3], "R", (role, rows[i][1]), i + 1, room)
        if i < len(rows):
            go(costs.delete, "D", None, i + 1, room)
            if not rows[i][2] and rows[i][0]:
                go(costs.keep + costs.truncated * rows[i][3], "K", rows[i][:2], i + 1, room)
        return min(ways, default=None)

    return rest(0, "o", most)


def judged(rows):
    """Rows (turn, role, text) in order -> rows of ``cheapest`` and the counts."""
    seen, out, faults = set(), [], []
    for _, role, text in rows:
        end = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
        out.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return out, [gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal]


def random_rows(rng, n):
    said = ["Hi.", "Hi.", "Who?", "No", "", " \n", "Well. ", "é!"]
    return [(rng.choice([None, rng.randint(0, 9)]) if rng.random() < 0.1 else i, rng.choice(["user", "assistant", "system", "user", "assistant", "tool", ""]), rng.choice(said)) for i in range(n)]


@pytest.mark.parametrize("costs", [Costs(), Costs(rerole=3, delete=4, insert=2, truncated=1), Costs(rerole=2, delete=2, insert=3)])
def test_paths_against_all_edits(costs):
    rng = random.Random(1)
    for _ in range(25):
        rows, _ = judged(random_rows(rng, rng.randint(0, 7)))
        cost, letters, _ = cheapest(rows, costs, most=8)
        cuts = sorted(rng.randint(0, len(rows)) for _ in range(rng.randint(0, 2)))
        parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)]) if a < b]  # in one piece and in several
        tables = [(len(p), dialogue.transfer([(r[:1], m, c) for r, _, m, c in p], costs)) for p in parts]
        got = dialogue.joined(tables, costs)
        assert got[:2] == (cost, letters)
        shares = dialogue.deal(got[1], [len(p) for p in parts])
        turns = [t for share, last, p in zip(shares, got[2], parts) for t in dialogue.rewritten(share, last, [(r, x) for r, x, _, _ in p])]
        assert "".join(shares) == letters * bool(parts) and (not parts or GOOD.fullmatch("".join(r[:1] for r, _ in turns)))


@pytest.mark.parametrize("most_rows", [512, 2])
def test_tables(spark, most_rows):
    rng = random.Random(2)
    rows = [(c, t, r, x) for c in [*range(12), None] for t, r, x in sorted(random_rows(rng, rng.randint(1, 5)), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))]
    rows += [(50, i, "user" if i % 2 else "assistant", f"Turn {i}.") for i in range(40)]  # longer than a chunk
    rows += [(51, None, None, None), (51, None, None, None), (52, 3, "user", "x " * 50_000 + "."), (52, 4, "assistant", "Ok.")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    verdicts, turns = dialogue.repair(df, most_rows=most_rows)
    found = {r.conv_id: r for r in verdicts.collect()}
    hashes = {r.conv_id: r.sha256 for r in dialogue.digests(turns).collect()}
    assert set(found) == {r[0] for r in rows}
    for conv, r in found.items():
        own = sorted(((t, a or " ", b or " ") if a is None or b is None else (t, a, b) for c, t, a, b in rows if c == conv), key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        usable, counts = judged(own)
        assert [r.gaps, r.blank, r.duplicate, r.truncated, r.illegal] == counts
        if len(own) <= 5:
            cost, letters, kept = cheapest(usable, Costs(), most=0)  # inserting costs more than two deletions
            assert (r.cost, r.audit) == (cost, letters)
            body = "\n".join(f"{a}:{b}" for a, b in kept).encode()
            assert hashes.get(conv, hashlib.sha256().hexdigest()) == hashlib.sha256(body).hexdigest()
    assert found[50].audit == "D" + "K" * 38 + "D" and found[50].cost == 4 and turns.where("conv_id = 50").count() == 38


def test_inserting_never_pays_at_the_usual_costs():
    rng = random.Random(4)
    for _ in range(100):
        rows, _ = judged(random_rows(rng, rng.randint(0, 9)))
        assert cheapest(rows, Costs(), most=4) == cheapest(rows, Costs(), most=0)


def test_damage(spark):
    rows = [(c, t, r, x) for c in (*range(20), None) for t, r, x in [(0, "system", "A. b!"), (1, "assistant", None), (None, None, "c?")]]
    out = {}
    for r in dialogue.damage(spark.createDataFrame(rows, SCHEMA)).collect():
        out.setdefault((r.conv_id, r.turn), []).append((r.role, r.text, r.present))
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        wanted = {1: (role, ""), 2: (role, re.sub("[.!?]", "", text)), 4: ("user", text)}.get(kind, (role, text))
        assert out[c, t] == [(*wanted, kind != 0)] * (2 if kind == 3 else 1)


def test_dropped_rows_empty_tables_and_clashing_names(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi.", "x", 1), (2, 0, "user", "Hi.", "y", 2)], SCHEMA + ", cost string, key int").selectExpr("*", "conv_id = 2 AS present")
    verdicts, turns = dialogue.repair(df)
    assert verdicts.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    assert sorted(map(tuple, verdicts.collect())) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 2, "D")] and turns.count() == 0
    verdicts, turns = dialogue.repair(df.where("false"))
    assert verdicts.count() == 0 and turns.count() == 0 and dialogue.digests(turns).count() == 0
