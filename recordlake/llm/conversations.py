"""Cheapest repair of the turn structure of conversations, with the least audit among the cheapest.

A conversation's rows, by turn, are to be edited until the roles read ``(s?(ua)+)?`` by their initials. Edits are
Keep (0), Rerole to user or assistant (1), Delete (2) and Insert of an empty turn of user or assistant (5); a truncated
row that isn't deleted costs 5 more; blank and repeated rows must be deleted. The audit is the initials of the edits in
order; of the cheapest audits the least in ASCII order counts. Steps:

1. Rows that are equal are one row with a count (all but the first copy are deleted). Rows are numbered in
   global order by a range sort, so a very long conversation is spread over partitions like any other rows.
2. Rows are taken in units of up to UNIT of them. What a unit does to the cost of getting from each state (start, after
   system, user, assistant) to each other is a 4 x 4 matrix; the matrices of a conversation that spans units are chained
   to the cost of what follows each unit. A unit gives a row to that chain, whatever its length.
3. With those costs each unit knows the optimal arcs at each of its nodes (row, state). Nodes are ranked by the first
   1, 2, 4, 8, ... letters of their least audit: a rank of 2n letters is that of n letters, then that of the node n arcs on,
   and pointers over n arcs double along. Ranks choose among arcs, pointers give all nodes of the least path at once.
4. Units that begin inside a conversation do so for each of the four states; their last states are chained, and the
   letters of the state that is met stay.
5. Letters and texts of a conversation stream through one task in order, which writes turns or digests them. Nothing is
   held but one row; that a digest of one text is made in one place is in the nature of the digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.llm.frames import map_groups, settle

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after an inserted or reroled turn in each state.
MADE = np.array([USER, USER, ASSISTANT, USER])
#: The state after a kept turn: by state, then by initial (s, u, a, other); -1 where it can't stay.
KEPT = np.array([[SYSTEM, USER, -1, -1], [-1, USER, -1, -1], [-1, -1, ASSISTANT, -1], [-1, USER, -1, -1]])
#: The cost of ending in each state: inserts up to the next assistant.
ENDING = np.array([0, 10, 5, 0])
#: Pairs of initials that may follow each other.
LEGAL = np.zeros((4, 4), dtype=bool)
LEGAL[[0, 1, 2], [1, 2, 1]] = True
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
FINE, BLANK, REPEATED, TRUNCATED = range(4)
LETTERS = np.frombuffer(b"DIKR", dtype=np.uint8)
NEVER = 1 << 40
#: Rows of a unit at most, as a power of two.
UNIT = 12

_KEY = ["missing", "conv"]


def node_costs(role: np.ndarray, fault: np.ndarray, copies: np.ndarray, begin: np.ndarray, count: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Costs from each node to the end, shape (nodes, 4 states, ends).

    Part p has the rows begin[p] to begin[p] + count[p] and one node more than rows, from begin[p] + p on; ``after``
    (parts, 4, ends) is the cost at its last node.
    """
    parts = len(begin)
    out = np.empty((len(role) + parts, 4, after.shape[2]), dtype=np.int64)
    out[begin + count + np.arange(parts)] = after
    cut = CUT_OFF * (fault == TRUNCATED)
    forced = (fault == BLANK) | (fault == REPEATED)
    order = np.argsort(-count, kind="stable")
    for i in range(int(count.max(initial=0)) - 1, -1, -1):
        p = order[:int(np.searchsorted(-count[order], -i, side="left"))]
        r = begin[p] + i
        onward = out[r + p + 1]
        to = KEPT[:, role[r]].T
        keep = np.where((to >= 0)[:, :, None], np.take_along_axis(onward, np.maximum(to, 0)[:, :, None], axis=1) + cut[r][:, None, None], NEVER)
        made = onward[:, MADE] + (REROLE + cut[r])[:, None, None]
        stay = np.where(forced[r][:, None, None], NEVER, np.minimum(keep, made))
        base = np.minimum(onward + DELETE, stay) + (DELETE * (copies[r] - 1))[:, None, None]
        best = base
        for _ in range(3):  # inserts lead round the states
            best = np.minimum(base, best[:, MADE] + INSERT)
        out[r + p] = best
    return out


def least_paths(role, fault, copies, begin, count, after, part, entry):
    """(letter, starts a row's last edit, path of each letter; last state of each path) of the least of the cheapest audits.

    Paths begin at the first node of ``part`` in the state ``entry``. ``after`` (parts, 4) are the costs behind each part.
    """
    cost = node_costs(role, fault, copies, begin, count, after[:, :, None])[:, :, 0]
    nodes = len(cost)
    owner = np.repeat(np.arange(len(begin)), count)
    at = np.arange(len(role)) + owner
    label = np.zeros((nodes, 4, 4), dtype=bool)
    target = np.zeros((nodes, 4, 4), dtype=np.int64)
    here, onward = cost[at], cost[at + 1] + (DELETE * (copies - 1))[:, None]
    cut = (CUT_OFF * (fault == TRUNCATED))[:, None]
    free = ~((fault == BLANK) | (fault == REPEATED))[:, None]
    state = np.arange(4)
    to = KEPT[:, role].T
    label[at, :, 0] = here == onward + DELETE
    target[at, :, 0] = (at[:, None] + 1) * 4 + state
    label[at, :, 1] = here == here[:, MADE] + INSERT
    target[at, :, 1] = at[:, None] * 4 + MADE
    label[at, :, 2] = free & (to >= 0) & (here == np.take_along_axis(onward, np.maximum(to, 0), axis=1) + cut)
    target[at, :, 2] = (at[:, None] + 1) * 4 + np.maximum(to, 0)
    label[at, :, 3] = free & (here == onward[:, MADE] + REROLE + cut)
    target[at, :, 3] = (at[:, None] + 1) * 4 + MADE
    label, target = label.reshape(-1, 4), target.reshape(-1, 4)
    last = ~label.any(axis=1)

    # nodes by their first letter, then by twice as many letters each time, along pointers that double too
    rank = np.zeros(len(label), dtype=np.int64)
    choice = np.where(label, np.arange(4) * (rank.max() + 1) + rank[target], NEVER).argmin(axis=1)
    jump = np.where(last, np.arange(len(label)), target[np.arange(len(label)), choice])
    rank = np.where(last, 0, choice + 1)
    steps = (~last).astype(np.int64)
    jumps = [jump]
    while not last[jump].all():
        rank = np.unique(rank * (rank.max() + 1) + rank[jump], return_inverse=True)[1]
        steps = steps + steps[jump]
        jump = jump[jump]
        jumps.append(jump)
    # the arcs of a node differ in their letter, so the ranks behind them confirm the choice of the first letter
    final = np.where(label, np.arange(4) * (rank.max() + 1) + rank[target], NEVER).argmin(axis=1)
    assert (final == choice)[~last].all()

    first = (begin[part] + part) * 4 + entry
    length = steps[first]
    path = np.repeat(np.arange(len(first)), length)
    turn = np.arange(len(path)) - np.repeat(np.cumsum(length) - length, length)
    node = first[path]
    for bit, pointer in enumerate(jumps):
        some = (turn >> bit) & 1 == 1
        node[some] = pointer[node[some]]
    return LETTERS[choice[node]], choice[node] != 1, path, jump[first] % 4, cost.reshape(-1)[first]


def _parts(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """First row and number of rows of each conversation in a table sorted by conversation."""
    missing, conv = np.asarray(t["missing"]), np.asarray(t["conv"])
    fresh = np.ones(len(conv), dtype=bool)
    fresh[1:] = (missing[1:] != missing[:-1]) | (conv[1:] != conv[:-1])
    begin = np.flatnonzero(fresh)
    return begin, np.diff(np.append(begin, len(conv)))


def _sorted(t: pa.Table) -> pa.Table:
    return t.take(pa.array(np.argsort(np.asarray(t["pos"]), kind="stable")))


def _matrices(t: pa.Table) -> pa.RecordBatch:
    """(unit, missing, conv, pos, matrix, first and last initial, illegal) of each conversation in a unit."""
    t = _sorted(t)
    role, fault, copies = (np.asarray(t[c]).astype(np.int64) for c in ("initial", "fault", "copies"))
    begin, count = _parts(t)
    identity = np.where(np.eye(4, dtype=bool), 0, NEVER)
    cost = node_costs(role, fault, copies, begin, count, np.broadcast_to(identity, (len(begin), 4, 4)))
    matrix = np.minimum(cost[begin + np.arange(len(begin))], NEVER).reshape(len(begin), 16)
    bad = copies - 1  # copies of any turn are an illegal pair
    inner = np.ones(len(role), dtype=bool)
    inner[begin] = False
    bad[1:] += inner[1:] & ~LEGAL[role[:-1], role[1:]]
    total = np.cumsum(bad)
    illegal = total[begin + count - 1] - total[begin] + bad[begin]
    one = lambda c: t[c].combine_chunks().take(pa.array(begin))
    return pa.RecordBatch.from_arrays(
        [one("unit"), one("missing"), one("conv"), one("pos"), pa.array([x.tobytes() for x in matrix], pa.binary()),
         pa.array(role[begin].astype(np.int32)), pa.array(role[begin + count - 1].astype(np.int32)), pa.array(illegal)],
        ["unit", "missing", "conv", "pos", "matrix", "first", "last", "illegal"])


_MATRICES = "unit long, missing boolean, conv long, pos long, matrix binary, first int, last int, illegal long"


def _chain_costs(t: pa.Table) -> pa.RecordBatch:
    """For each unit of a conversation the costs behind it, whether it is the first, and illegal pairs with the unit before."""
    t = _sorted(t)
    costs, after = ENDING.astype(np.int64), []
    for raw in reversed(t["matrix"].to_pylist()):
        after.append(costs.tobytes())
        matrix = np.frombuffer(raw, dtype=np.int64).reshape(4, 4)
        costs = np.minimum(matrix + costs[None, :], NEVER).min(axis=1)
    first, last = np.asarray(t["first"]), np.asarray(t["last"])
    seam = np.concatenate([[0], (~LEGAL[last[:-1], first[1:]]).astype(np.int64)])
    return pa.RecordBatch.from_arrays(
        [*(t[c].combine_chunks() for c in ("unit", "missing", "conv")), pa.array(after[::-1], pa.binary()),
         pa.array(np.arange(len(seam)) == 0), pa.array(seam)], ["unit", "missing", "conv", "after", "whole", "seam"])


def _letters(t: pa.Table) -> pa.RecordBatch:
    """The edits of each row of a unit, for each state in which its conversation may enter the unit."""
    t = _sorted(t)
    role, fault, copies = (np.asarray(t[c]).astype(np.int64) for c in ("initial", "fault", "copies"))
    begin, count = _parts(t)
    firsts = t.take(pa.array(begin))
    after = np.array([np.frombuffer(x, dtype=np.int64) if x else ENDING for x in firsts["after"].to_pylist()])
    whole = np.array([x is not False for x in firsts["whole"].to_pylist()])
    part = np.concatenate([np.arange(len(begin)), *[np.flatnonzero(~whole)] * 3])
    entry = np.concatenate([np.zeros(len(begin), dtype=np.int64), *[np.full(int((~whole).sum()), s) for s in (1, 2, 3)]])
    letter, ends, path, state, cost = least_paths(role, fault, copies, begin, count, after, part, entry)
    size = count[part]
    row = np.repeat(begin[part] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
    at = np.concatenate([[0], np.flatnonzero(ends) + 1]).astype(np.int32)
    which = np.repeat(np.arange(len(part)), size)
    last = np.zeros(len(row), dtype=bool)
    last[np.cumsum(size) - 1] = True
    text = pa.Array.from_buffers(pa.string(), len(row), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(letter.tobytes())])
    own = t.select(["unit", "missing", "conv", "pos", "turn", "role", "digest", "copies"]).take(pa.array(row)).combine_chunks().to_batches()[0]
    return pa.RecordBatch.from_arrays(
        [*own.columns, pa.array(entry[which].astype(np.int32)), text, pa.array(np.where(last, state[which], -1).astype(np.int32)),
         pa.array(cost[which]), pa.array(whole[part][which])],
        [*own.schema.names, "entry", "letters", "state", "cost", "whole"])


_LETTERS = ("unit long, missing boolean, conv long, pos long, turn long, role string, digest string, copies long, "
            "entry int, letters string, state int, cost long, whole boolean")


def _chain_states(t: pa.Table) -> pa.RecordBatch:
    """The state in which the least path enters each unit of a conversation."""
    order = np.lexsort((np.asarray(t["entry"]), np.asarray(t["unit"])))
    unit, entry, state = (np.asarray(t[c])[order] for c in ("unit", "entry", "state"))
    now, units, entries = START, [], []
    for u, e, s in zip(unit.tolist(), entry.tolist(), state.tolist()):
        if units and units[-1] == u:
            continue
        if e == now:
            units.append(u)
            entries.append(e)
            now = s
    n = len(units)
    return pa.RecordBatch.from_arrays([pa.array(units, pa.int64()), t["missing"].combine_chunks().slice(0, 1).take(pa.array([0] * n)),
                                       t["conv"].combine_chunks().slice(0, 1).take(pa.array([0] * n)), pa.array(entries, pa.int32())],
                                      ["unit", "missing", "conv", "met"])


_ROLE = {USER: "user", ASSISTANT: "assistant"}


def _edited(state: int, letters: str, role: str, text: str) -> Iterator[tuple[int, str, str]]:
    """(state, role, text) of the turns that a row's edits leave, in order."""
    for x in letters:
        if x == "K":
            state = int(KEPT[state, "sua".find(role[:1]) if role[:1] in ("s", "u", "a") else 3])
            yield state, role, text
        elif x != "D":
            state = int(MADE[state])
            yield state, _ROLE[state], text if x == "R" else ""


class _Conversation:
    """The repaired turns of one conversation as they stream by."""

    def __init__(self):
        self.state, self.audit, self.sha, self.n = START, [], hashlib.sha256(), 0

    def turns(self, letters: str, role: str, text: str) -> list[tuple[int, str, str]]:
        self.audit.append(letters)
        out = []
        for self.state, r, x in _edited(self.state, letters, role, text):
            self.sha.update(((f"\n{r}:{x}") if self.n else f"{r}:{x}").encode())
            out.append((self.n, r, x))
            self.n += 1
        return out

    def end(self) -> list[tuple[int, str, str]]:
        """What is inserted behind the last row."""
        return self.turns("I" * int(ENDING[self.state] // INSERT), "", "")


def _assemble(rows: DataFrame, turns: bool) -> DataFrame:
    """The audit and digest of each conversation, or its turns, from letters (kind 0) each followed by its copies (kind 1)."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, key, letters, fresh = None, None, "", False
        out: list[tuple] = []

        def close() -> None:
            more = now.end()
            if turns:
                out.extend((*key, *x) for x in more)
            else:
                out.append((*key, "".join(now.audit), now.sha.hexdigest()))

        def batch_of() -> pa.RecordBatch:
            kinds = [pa.bool_(), pa.int64(), *((pa.int64(), pa.string(), pa.string()) if turns else (pa.string(), pa.string()))]
            names = ["missing", "conv", *(("n", "role", "text") if turns else ("audit", "sha"))]
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
            out.clear()
            return made

        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("missing", "conv", "kind", "role", "body")]
            for missing, conv, kind, role, body in zip(*cols):
                if (missing, conv) != key:
                    if now is not None:
                        close()
                    now, key = _Conversation(), (missing, conv)
                if kind == 0:
                    letters, fresh = body, True
                else:
                    made = now.turns(letters if fresh else "D", role, body)
                    fresh = False
                    if turns:
                        out.extend((*key, *x) for x in made)
            if out:
                yield batch_of()
        if now is not None:
            close()
        if out:
            yield batch_of()
    schema = "missing boolean, conv long, n long, role string, text string" if turns else "missing boolean, conv long, audit string, sha string"
    order = ["missing", "conv", F.col("turn").asc_nulls_first(), "role", "digest", "kind"]
    return rows.repartition(*_KEY).sortWithinPartitions(*order).select("missing", "conv", "kind", "role", "body").mapInArrow(each, schema)


def _first(column: str, *names: str) -> Column:
    out = F.lit(len(names))
    for i, name in reversed(list(enumerate(names))):
        out = F.when(F.col(column).startswith(name), F.lit(i)).otherwise(out)
    return out


class Repair:
    """The repair of all conversations of a table; every step is written to the shared folder.

    ``conv`` and ``turn`` are integers; null roles and texts are one space. Rows are ordered by turn, nulls first,
    then by role and the text's digest (which only matters for different rows of one turn). A null conversation id is a
    conversation of its own. Equal rows are copies of each other; the first one counts. Roles other than system, user
    and assistant can be reroled or deleted; only the first character of a role counts. Other columns are not looked at; an
    empty table has no conversations.
    """

    def __init__(self, rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"):
        c = F.col(f"`{conv}`").cast("long")
        self.texts = rows.select(c.isNull().alias("missing"), F.coalesce(c, F.lit(0).cast("long")).alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
                                 F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" ")).alias("role"),
                                 F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" ")).alias("text")).withColumn("digest", F.md5("text"))
        blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
        cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
        same = [*_KEY, "turn", "role", "digest"]
        rows = settle(self.texts.select(*same, F.when(blank, BLANK).when(cut, TRUNCATED).otherwise(FINE).alias("fault"))
                      .groupBy(*same).agg(F.first("fault").alias("fault"), F.count(F.lit(1)).alias("copies")), "turns")
        when = F.struct(F.col("turn").isNotNull(), "turn")
        seen = settle(rows.groupBy(*_KEY, "role", "digest").agg(F.min(when).alias("first")), "seen")
        again = when != F.col("first")
        rows = rows.join(seen, [*_KEY, "role", "digest"]).select(
            *same, "copies", _first("role", "s", "u", "a").alias("initial"),
            F.when(F.col("fault") == BLANK, BLANK).when(again, REPEATED).otherwise(F.col("fault")).alias("fault"))
        order = [*_KEY, F.col("turn").asc_nulls_first(), "role", "digest"]
        self.rows = settle(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pos", F.monotonically_increasing_id()), "ordered")
        rows = self.rows.withColumn("unit", F.shiftright("pos", UNIT))
        parts = settle(map_groups(rows.select("unit", *_KEY, "pos", "initial", "fault", "copies"), ["unit"], _matrices, _MATRICES), "parts")
        several = parts.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("units")).where("units > 1").select(*_KEY)
        chained = settle(map_groups(parts.join(several, _KEY), _KEY, _chain_costs,
                                    "unit long, missing boolean, conv long, after binary, whole boolean, seam long"), "chained")
        letters = settle(map_groups(rows.join(chained, ["unit", *_KEY], "left"), ["unit"], _letters, _LETTERS), "letters")
        ends = letters.join(chained.select("unit", *_KEY), ["unit", *_KEY]).where("state >= 0").select("unit", *_KEY, "entry", "state")
        met = settle(map_groups(ends, _KEY, _chain_states, "unit long, missing boolean, conv long, met int"), "met")
        self.letters = (letters.join(met, ["unit", *_KEY], "left").where(F.col("entry") == F.coalesce("met", F.lit(START))))
        self.parts, self.chained = parts, chained

    def _stream(self, turns: bool) -> DataFrame:
        one = self.letters.select(*_KEY, "turn", "role", "digest", F.lit(0).alias("kind"), F.col("letters").alias("body"))
        two = self.texts.select(*_KEY, "turn", "role", "digest", F.lit(1).alias("kind"), F.col("text").alias("body"))
        return _assemble(one.unionByName(two), turns)

    def turns(self) -> DataFrame:
        """(conv_id, n, role, text): the repaired turns, numbered from 0."""
        return self._stream(True).select(F.when(~F.col("missing"), F.col("conv")).alias("conv_id"), "n", "role", "text")

    def summary(self) -> DataFrame:
        """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
        number = F.col("copies")
        plain = self.rows.groupBy(*_KEY).agg(
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
            F.sum(F.when(F.col("fault") == BLANK, number).otherwise(0)).cast("long").alias("blank"),
            F.sum(F.when(F.col("fault") == BLANK, 0).when(F.col("fault") == REPEATED, number).otherwise(number - 1)).cast("long").alias("duplicate"),
            F.count_if(F.col("fault") == TRUNCATED).alias("truncated"))
        seams = self.chained.select(*_KEY, F.col("seam").alias("illegal"))
        illegal = self.parts.select(*_KEY, "illegal").unionByName(seams).groupBy(*_KEY).agg(F.sum("illegal").alias("illegal"))
        cost = self.letters.where("whole").groupBy(*_KEY).agg(F.max("cost").alias("cost"))
        out = plain.join(illegal, _KEY).join(cost, _KEY).join(self._stream(False), _KEY)
        return out.select(F.when(~F.col("missing"), F.col("conv")).alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost",
                          "audit", F.col("sha").alias("repaired_sha256"))


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults by crc32 of ``conv_id:turn`` modulo 20; nulls are one space there and in role and text.

    0 drops a row, 1 empties its text, 2 takes full stops, exclamation and question marks out, 3 repeats it, 4 makes it the user's.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    rows = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def repaired(rows: DataFrame) -> DataFrame:
    """The summary of the damaged conversations, and a row of zeros for each one that lost all its rows."""
    found = Repair(damaged(rows)).summary()
    every = rows.select(F.col("conv_id").cast("long").alias("own")).distinct()
    out = every.join(found, F.col("own").eqNullSafe(F.col("conv_id")), "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("own").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
