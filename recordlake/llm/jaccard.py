"""Jaccard join of documents on word n-grams by token-combination prefixes; exact.

A document's tokens are its distinct shingles of ``k`` words. Two sets are linked when
``100 * intersection >= percent * union``. Steps:

1. Tokens that many documents have are counted (among the first tokens of each document in hash order, which
   are the ones an index would meet) and marked in bitmaps of fixed size. Tokens are thereby of three classes: rare
   ones are indexed alone, frequent ones in twos, very frequent ones in threes. Any marking that is the same for
   all documents keeps the join exact; a mark too many only costs some index rows.
2. Of a set of n tokens at most ``n - ceil(percent * n / 100)`` are missing in a linked one. Tokens
   are ordered by class, then hash. A class of k-combinations is dealt by hash into groups; m tokens of
   a group are worth m - (k - 1) of what the prefix needs, so the prefix extends until the tokens are worth more
   than what may be missing. Then a linked pair shares k tokens of one group within both prefixes, whose
   combination is a key. Groups follow the level of the set's size (a power of two), so that a prefix has a
   number of keys proportional to its length; sets just under the next level are indexed there, too.
3. Sets that are equal are one node from the start. A key's nodes are first compared with its smallest node (star), then
   only nodes of different components are, in blocks of bounded size.
4. Parity bitmaps of the sets bound the symmetric difference from below and rule most pairs out; what is left
   is verified on the full shingle sets, and connected components follow.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm.confirm import confirmed
from recordlake.llm.frames import FILTER_BITS, Bitmap, bitmap_filter, components, map_arrow, settle
from recordlake.llm.textkit import mix, shingle_sets, texts_of, words_of

#: Documents that may have a token which is indexed alone, and one which is indexed in twos.
RARE = 8
COMMON = 256
#: Tokens gathered in a task before they are counted there.
GATHER = 1 << 18
#: Members of a key that are compared as one group.
BLOCK = 512


class Marks(Bitmap):
    """Tokens in a bitmap of fixed size, by their low bits (the high bits order the prefixes)."""

    @staticmethod
    def slot(name: str):
        return F.col(name).bitwiseAND(F.lit(FILTER_BITS - 1))


def _missing(n, percent: int):
    """How many tokens of a set of n a linked set may lack."""
    return n - -(-n * percent // 100)


def _level(n: np.ndarray) -> np.ndarray:
    return np.frexp(np.maximum(n, 1).astype(np.float64))[1].astype(np.int64) - 1


def _frequent(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(token, n): in how many documents each token is among the first ones in hash order."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            token, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(token.astype(np.int64)), pa.array(n)], ["token", "n"])

        for batch in batches:
            for t in texts_of(batch.column(0)):
                keys, at = shingle_sets(words_of(t, lower=True), k)
                size = np.diff(at)
                first = np.arange(len(keys)) - np.repeat(at[:-1], size)
                held.append(keys[first < np.repeat(2 * _missing(size, percent) + 6, size)])
                if sum(map(len, held)) >= GATHER:
                    yield flush()
        if held:
            yield flush()
    counted = docs.select("text").mapInArrow(each, "token long, n long")
    return counted.groupBy("token").agg(F.sum("n").alias("n"))


def _ranks(group: np.ndarray) -> np.ndarray:
    """How many earlier entries of its group each entry has."""
    order = np.argsort(group, kind="stable")
    g = group[order]
    first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, dtype=np.int64)
    out = np.empty(len(g), dtype=np.int64)
    out[order] = np.arange(len(g)) - np.repeat(first, np.diff(np.append(first, len(g))))
    return out


def _combinations(group: np.ndarray, token: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of an entry, key) of all combinations of ``many`` entries of a group; entries of a group are neighbours."""
    at, key = np.arange(len(group)), mix(token + np.uint64(many))
    ends = [(at, at, key)]
    for _ in range(many - 1):
        longer = []
        for first, last, so_far in ends:
            step = 1
            while len(first):
                ok = last + step < len(group)
                first, last, so_far = first[ok], last[ok], so_far[ok]
                ok = group[last + step] == group[first]
                first, last, so_far = first[ok], last[ok], so_far[ok]
                if len(first):
                    longer.append((first, last + step, mix(so_far ^ mix(token[last + step]))))
                step += 1
        ends = longer
    if not ends:
        return at[:0], key[:0]
    return np.concatenate([x[0] for x in ends]), np.concatenate([x[2] for x in ends])


def prefix_keys(keys: np.ndarray, at: np.ndarray, kind: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(set, key): the index keys of each set of ascending tokens; ``kind`` is how many tokens make a key (1 to 3)."""
    size = np.diff(at)
    need = _missing(size, percent) + 1
    own, above = _level(size), _level(size * 100 // percent)
    out = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64))]
    # the smallest sets are linked to equal ones alone: they may lack no token, and one more would be too many
    real = (need > 1) | (size * 100 // percent > size)
    for level, chosen in ((own, real), (above, real & (above != own))):
        some = np.flatnonzero(chosen)
        if not len(some):
            continue
        where = np.repeat(at[some] - np.cumsum(size[some]) + size[some], size[some]) + np.arange(int(size[some].sum()))
        token, k, doc = keys[where], kind[where].astype(np.int64), np.repeat(some, size[some])
        order = np.argsort(doc * 4 + k, kind="stable")
        token, k, doc = token[order], k[order], doc[order]
        # about as many groups as leave three tokens worth two, or five worth three, in each
        worth = _missing(1 << level, percent) + 1
        groups = np.where(k == 2, np.maximum(1, worth // 2)[doc], np.maximum(1, worth // 3)[doc])
        group = (doc * 4 + k) * (1 << 32) + np.where(k > 1, (mix(token) >> np.uint64(8)).astype(np.int64) % groups, 0)
        adds = np.ones(len(token), dtype=np.int64)
        more = k > 1
        adds[more] = _ranks(group[more]) >= k[more] - 1
        total = np.cumsum(adds) - adds
        begin = np.searchsorted(doc, some)
        use = total - np.repeat(total[begin], size[some]) < need[doc]
        salt = mix(level[doc].astype(np.uint64) + np.uint64(1))
        for many in (1, 2, 3):
            mine = np.flatnonzero(use & (k == many))
            if many == 1:
                out.append((doc[mine], mix(token[mine] ^ salt[mine])))
            elif len(mine):
                mine = mine[np.argsort(group[mine], kind="stable")]
                entry, key = _combinations(group[mine], token[mine], many)
                out.append((doc[mine][entry], mix(key ^ salt[mine][entry])))
    return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])


def parities(keys: np.ndarray, at: np.ndarray) -> list[bytes]:
    """For each set a bitmap in which each token turns one bit over; its length is a power of two near the set's size."""
    size = np.diff(at)
    bits = np.maximum(64, 2 << _level(size))
    begin = np.cumsum(bits) - bits
    slot = (keys & np.repeat(bits - 1, size).astype(np.uint64)).astype(np.int64) + np.repeat(begin, size)
    packed = np.packbits((np.bincount(slot, minlength=int(bits.sum())) & 1).astype(np.uint8), bitorder="little")
    return [packed[a // 8:(a + b) // 8].tobytes() for a, b in zip(begin.tolist(), bits.tolist())]


def _folded(maps: list[bytes], length: int) -> np.ndarray:
    """Bitmaps folded to ``length`` bytes, as 64-bit integers; the parity of a shorter map follows from a longer one."""
    out = np.zeros((len(maps), length // 8), dtype=np.uint64)
    sizes = np.array([len(x) for x in maps])
    for n in np.unique(sizes).tolist():
        which = np.flatnonzero(sizes == n)
        m = np.frombuffer(b"".join(maps[i] for i in which.tolist()), dtype=np.uint64).reshape(len(which), n // length, length // 8)
        out[which] = np.bitwise_xor.reduce(m, axis=1)
    return out


def near(na: np.ndarray, nb: np.ndarray, a: list[bytes], b: list[bytes], percent: int) -> np.ndarray:
    """Which pairs of sets may be linked, from their sizes and bitmaps; no linked pair is ruled out."""
    ok = 100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)
    least = np.minimum([len(x) for x in a], [len(x) for x in b])
    for n in np.unique(least[ok]).tolist():
        some = np.flatnonzero(ok & (least == n))
        for lo in range(0, len(some), 4096):
            part = some[lo:lo + 4096]
            x = _folded([a[i] for i in part], n) ^ _folded([b[i] for i in part], n)
            differ = np.bitwise_count(x).sum(axis=1, dtype=np.int64)
            ok[part] = differ * (100 + percent) <= (na[part] + nb[part]) * (100 - percent)
    return ok


def _sets(docs: DataFrame, k: int, percent: int, twos: Marks, threes: Marks) -> DataFrame:
    """(doc_id, n, digest, keys, bits) of each row; without words n is 0 and the others are null."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for t in texts_of(batch.column(1)):
            keys, at = shingle_sets(words_of(t, lower=True), k)
            slot = keys & np.uint64(FILTER_BITS - 1)
            kind = 1 + twos.hits(slot).astype(np.int8)
            kind += threes.hits(slot) & (kind == 2)
            owner, found = prefix_keys(keys, at, kind, percent)
            order = np.argsort(owner, kind="stable")
            ends = np.searchsorted(owner[order], np.arange(len(t) + 1)).astype(np.int32)
            some = np.diff(at) > 0
            digest = [hashlib.blake2b(keys[a:b].tobytes(), digest_size=16).digest() if a < b else None for a, b in zip(at, at[1:])]
            bits = [x if y else None for x, y in zip(parities(keys, at), some)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(t.first, len(t)), pa.array(np.diff(at)), pa.array(digest, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(found[order].view(np.int64))), pa.array(bits, pa.binary())],
                ["doc_id", "n", "digest", "keys", "bits"])
    return map_arrow(docs, run, "doc_id long, n long, digest binary, keys array<long>, bits binary")


def _near_pairs(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes whose sizes and bitmaps allow a link."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"m{x}"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        t = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        ok = pa.array(near(np.asarray(t["na"]), np.asarray(t["nb"]), t["ma"].to_pylist(), t["mb"].to_pylist(), percent))
        return pa.RecordBatch.from_arrays([t["a"].filter(ok), t["b"].filter(ok)], ["a", "b"])
    fits = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    return map_arrow(pairs.join(side("a"), "a").join(side("b"), "b").where(fits).select("a", "b", "na", "nb", "ma", "mb"), run, "a long, b long")


def _dealt(members: DataFrame) -> DataFrame:
    """Members (key, node, comp) of keys with several components, dealt to groups of bounded size.

    Nodes of the key's largest component meet the others, the others meet each other; ``side`` tells rows apart that need
    not meet (-1: all pairs). Every pair of different components is in one group at least.
    """
    per = members.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
    whole = settle(per.groupBy("key").agg(F.count(F.lit(1)).alias("comps"), F.sum("c").alias("all"), F.max(F.struct("c", "comp")).alias("m"))
                   .where("comps > 1")
                   .select("key", F.col("m.comp").alias("base"), F.ceil(F.col("m.c") / BLOCK).cast("int").alias("nb"),
                           F.greatest(F.lit(1), F.ceil((F.col("all") - F.col("m.c")) / BLOCK)).cast("int").alias("no"), "all"), "several")
    rows = members.join(whole, "key")
    small = rows.where(F.col("all") <= BLOCK).select("key", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(-1).alias("side"), "node", "comp")
    large = rows.where(F.col("all") > BLOCK).withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("comp") == F.col("base"), F.col("nb")).otherwise(F.col("no"))).cast("int"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    base = large.where("comp = base").select("key", (-1 - F.col("own")).alias("i"), F.explode(upto("no")).alias("j"), F.lit(0).alias("side"), "node", "comp")
    rest = large.where("comp <> base")
    cross = rest.select("key", F.explode(F.transform(upto("nb"), lambda x: -1 - x)).alias("i"), F.col("own").alias("j"), F.lit(1).alias("side"), "node", "comp")
    among = (rest.select("key", "own", "node", "comp", F.explode(upto("no")).alias("x"))
             .select("key", F.least("own", "x").alias("i"), F.greatest("own", "x").alias("j"),
                     F.when(F.col("own") == F.col("x"), -1).otherwise((F.col("own") < F.col("x")).cast("int")).alias("side"), "node", "comp"))
    return small.unionByName(base).unionByName(cross).unionByName(among)


def _group_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), a < b, of a group's rows of different components and sides that may be linked."""
    def pairs(t: pa.Table) -> pa.RecordBatch | None:
        key, i, j, side, node, comp, n = (np.asarray(t[c]) for c in ("key", "i", "j", "side", "node", "comp", "n"))
        bits = t["bits"].to_pylist()
        fresh = np.ones(len(key), dtype=bool)
        fresh[1:] = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        group = np.cumsum(fresh)
        x, step, found = np.arange(len(key)), 1, []
        while len(x := x[x + step < len(key)]) and len(x := x[group[x + step] == group[x]]):
            y = x + step
            ok = (comp[x] != comp[y]) & ((side[x] < 0) | (side[x] != side[y])) & (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y]))
            u, v = x[ok], y[ok]
            if len(u):
                ok = near(n[u], n[v], [bits[p] for p in u.tolist()], [bits[p] for p in v.tolist()], percent)
                u, v = node[u[ok]], node[v[ok]]
                if len(u):
                    found.append(np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)], axis=1), axis=0))
            step += 1
        if not found:
            return None
        both = np.unique(np.concatenate(found), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            # the last group may go on in the next batch
            same = np.ones(t.num_rows, dtype=bool)
            for c in ("key", "i", "j"):
                v = t[c].to_numpy()
                same &= v == v[-1]
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            held = t.slice(cut)
            if cut and (out := pairs(t.slice(0, cut).combine_chunks())) is not None:
                yield out
        if held is not None and (out := pairs(held.combine_chunks())) is not None:
            yield out
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(each, "a long, b long")


def _texts_of(named: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, text) of the documents in pairs."""
    wanted = settle(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct(), "wanted")
    some = bitmap_filter(named, "doc_id", wanted, "node").withColumnRenamed("doc_id", "node")
    return settle(some.join(wanted, "node").select("node", "text"), "texts")


def jaccard_join(docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = 3, percent: int = 90,
                 rare: int = RARE, common: int = COMMON) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    ``component_id`` is the smallest id reachable over links, its own included. ``percent`` is from 80 to 100. Words are
    runs of bytes other than white space, A-Z in lower case; fewer than ``k`` words are one shingle. Null and empty texts,
    and texts without words, have no set and no link. Rows that repeat an id are one node: what either links to, both are
    linked to. A row with a null id takes no part: its component_id is null. An empty table gives an empty
    table; other columns are not looked at. ``rare`` and ``common`` bound the documents of a token that is
    indexed alone or in twos; they change the work, not the result.
    """
    assert 80 <= percent <= 100
    named = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    counts = settle(_frequent(named, k, percent).where(F.col("n") > rare), "frequent")
    twos, threes = Marks(counts, "token"), Marks(counts.where(F.col("n") > common), "token")
    rows = settle(_sets(named, k, percent, twos, threes), "sets")
    real = rows.where("doc_id is not null and n > 0")
    # equal sets have equal keys and bitmaps
    nodes = settle(real.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("keys").alias("keys"),
                                              F.first("bits").alias("bits")), "nodes")
    named = named.where("doc_id is not null")

    keys = nodes.select("node", F.explode("keys").alias("key"))
    lows = settle(keys.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("key", "low"), "lows")
    shared = settle(keys.join(lows, "key").distinct(), "shared")
    star = settle(_near_pairs(shared.where("node <> low").select(F.col("low").alias("a"), F.col("node").alias("b")).distinct(), nodes, percent)
                  .distinct(), "star")
    links = settle(confirmed(star, _texts_of(named, star), k, percent), "links")

    comps = components(links)
    held = settle(shared.select("key", "node").join(comps, "node", "left").select("key", "node", F.coalesce("component", "node").alias("comp")), "held")
    groups = _dealt(held).join(nodes.select("node", "n", "bits"), "node")
    rest = settle(_group_pairs(groups, percent).distinct(), "rest")
    more = confirmed(rest, _texts_of(named, rest), k, percent)

    classes = nodes.select("digest", "node")
    same = real.select("doc_id", "digest").join(classes, "digest").where("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    comps = components(links.unionByName(more).unionByName(same))
    out = rows.select("doc_id", F.col("n").alias("n_shingles")).join(comps.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
