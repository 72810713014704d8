import hashlib
import random
import re
import sys
import zlib
from functools import cache

import pytest

from recordlake.llm import conversations as C

SF = "/root/testdata/sf0.1"
SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        show = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def digest(x):
    return hashlib.sha256(x.encode()).hexdigest()


def brute(rows):
    """{conv_id: summary} from all edits of each conversation, the least audit among the cheapest."""
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return {conv: one(own) for conv, own in by.items()}


def one(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
    fault, seen = [], set()
    for _, role, text in rows:
        body = text.rstrip(SPACE)
        fault.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))

    #: state -> initials that may come next, and the state they lead to
    follow = {"start": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @cache
    def best(i, state, inserts):
        """(cost, audit, turns) of the rest; at most three inserts in a row are of use."""
        found = [(0, "", ())] if i == len(rows) and state in ("start", "a") else []
        made = "a" if state == "u" else "u"
        name = {"u": "user", "a": "assistant"}[made]
        if inserts < 3:
            cost, audit, turns = best(i, made, inserts + 1)
            found.append((cost + 5, "I" + audit, (f"{name}:", *turns)))
        if i < len(rows):
            _, role, text = rows[i]
            cost, audit, turns = best(i + 1, state, 0)
            found.append((cost + 2, "D" + audit, turns))
            if fault[i] not in ("blank", "duplicate"):
                more = 5 if fault[i] == "truncated" else 0
                if role[:1] in follow[state]:
                    cost, audit, turns = best(i + 1, follow[state][role[:1]], 0)
                    found.append((cost + more, "K" + audit, (f"{role}:{text}", *turns)))
                cost, audit, turns = best(i + 1, made, 0)
                found.append((cost + more + 1, "R" + audit, (f"{name}:{text}", *turns)))
        return min(found) if found else (10**9, "", ())

    cost, audit, turns = best(0, "start", 0)
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (gaps, *(fault.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest("\n".join(turns)))


def result(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def test_table_against_all_edits(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    want = brute(damage(rows))
    got = result(C.repaired(df))
    assert set(got) == {r[0] for r in rows}
    assert {k: v for k, v in got.items() if k in want} == want
    assert all(v == (0, 0, 0, 0, 0, 0, "", digest("")) for k, v in got.items() if k not in want)


def random_rows(seed, conversations, most, alphabet=("user", "assistant", "system", "tool", "", "User", None)):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "and so", " ", "", "Why? \n", "x.", None, "ok"]
    rows = []
    for c in range(conversations):
        n = rng.randint(1, most)
        for i in range(n):
            turn = rng.choice([i, i, i, i + rng.randint(0, 3), None])
            rows.append((c if c else None, turn, rng.choices(alphabet, [6, 6, 1, 1, .3, .3, .3])[0], rng.choice(texts) if rng.random() < .5 else f"t{i}."))
    return rows


@pytest.mark.parametrize("unit", [12, 2])
def test_random_conversations(spark, monkeypatch, unit):
    """Ties of turns, nulls, odd roles; with units of four rows most conversations span several."""
    monkeypatch.setattr(C, "UNIT", unit)
    rows = random_rows(unit, 120, 14)
    want = brute(rows)
    assert result(C.Repair(spark.createDataFrame(rows, SCHEMA)).summary()) == want


def test_long_conversation_spans_units_and_partitions(spark, monkeypatch):
    monkeypatch.setattr(C, "UNIT", 4)
    sys.setrecursionlimit(20000)  # of the brute force
    rng = random.Random(3)
    rows = [(1, i, rng.choice(["user", "assistant", "system"]), f"{i}" + rng.choice([".", "", "!"])) for i in range(400)]
    rows += [(1, 400, "user", "the same.")] * 50 + [(2, 0, "user", "Hi."), (2, 1, "assistant", "Yes.")]
    assert result(C.Repair(spark.createDataFrame(rows, SCHEMA).repartition(7)).summary()) == brute(rows)


def test_repaired_turns(spark):
    rows = [(7, 0, "system", "Be brief."), (7, 1, "user", "Hi."), (7, 2, "user", "Hi."), (7, 3, "tool", "Done."), (7, 4, "user", "Bye.")]
    got = sorted((r.n, r.role, r.text) for r in C.Repair(spark.createDataFrame(rows, SCHEMA)).turns().collect())
    assert got == [(0, "system", "Be brief."), (1, "user", "Hi."), (2, "assistant", "Bye.")]
    assert brute(rows)[7][6] == "KKDDR"


def test_edge_tables(spark):
    assert C.repaired(spark.createDataFrame([], SCHEMA)).collect() == []
    clashing = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes.")], SCHEMA).selectExpr(
        "*", "1 AS conv", "2 AS pos", "3 AS copies", "4 AS kind", "5 AS missing")
    assert result(C.Repair(clashing).summary()) == {1: (0, 0, 0, 0, 0, 0, "KK", digest("user:Hi.\nassistant:Yes."))}
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert result(C.repaired(spark.createDataFrame([(lost, 0, "user", "Hi.")], SCHEMA))) == {lost: (0, 0, 0, 0, 0, 0, "", digest(""))}
