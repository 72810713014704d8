"""Near-duplicate documents by SetSketch registers, banding, joint estimates and full verification.

A document's set holds its distinct shingles of ``k`` words. Documents are linked when
``100 * intersection >= percent * union``, confirmed on the full sets. The steps:

1. One pass over the texts gives each document its set size, a digest of the set and its sketch.
   Documents with equal sets form a class; its smallest doc_id stands for it from here on, so
   copies never meet in pairs.
2. Bands of ``ROWS`` register values become keys. The number of bands follows from the threshold, so
   that a pair at the threshold shares no key with a probability under ``MISS``.
3. Star: every member of a bucket is compared with the bucket's smallest member. Likelihood estimates
   from the registers drop hopeless pairs, full sets confirm the rest, and connected components follow.
   That is linear in the bucket and merges most of a large group of near copies.
4. Rest: in a bucket that still holds several components, all pairs of different components are
   compared by their registers, in blocks of bounded size: the largest component against the
   others, and the others among themselves. Pairs inside a component are never looked at. What
   the estimate leaves is confirmed on the full sets, and components are formed again.

A sketch register is the floor of a logarithm of the smallest of exponential values that the set's
elements throw at it: values are spaced exponentially and truncated, registers of a union are the
larger registers, and two sets agree in a register about as often as their Jaccard similarity says.
An element's values come from one Poisson process whose points are dealt to registers at random,
so only the few points that can be minima are ever made.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm.confirm import confirmed
from recordlake.llm.frames import bitmap_filter, components, map_arrow, map_groups, settle
from recordlake.llm.textkit import mix, shingle_sets, texts_of, words_of

REGISTERS = 420
BASE = 1.005
RATE = 20.0
TOP = 65534
ROWS = 7
MISS = 1e-6
#: Standard deviations under the threshold down to which an estimate is still verified.
SLACK = 4.5
#: Members of a bucket compared with as many others in one group.
BLOCK = 512


def bands(percent: int) -> int:
    n = math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** ROWS))
    return min(n, REGISTERS // ROWS)


def _registers(low: np.ndarray) -> np.ndarray:
    """Register values of the smallest process points."""
    return np.clip(np.floor(1 - np.log(low / RATE) / math.log(BASE)), 0, TOP + 1).astype(np.uint16)


def sketches(sets: np.ndarray, at: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """SetSketch registers of each set of 64-bit hashes; an empty set has zeros."""
    size = np.diff(at)
    low = np.full((len(size), m), np.inf)
    reach = (math.log(m) + 4) / np.maximum(size, 1)
    todo = np.flatnonzero(size)
    while len(todo):
        for few in (True, False):
            part = todo[(size[todo] < 48) == few]
            if len(part):
                (_points_at_once if few else _points_in_turn)(sets, at, size, part, reach, low, m)
        todo = todo[np.isinf(low[todo]).any(axis=1)]
        low[todo] = np.inf
        reach[todo] *= 2
    out = np.zeros((len(size), m), dtype=np.uint16)
    full = size > 0
    out[full] = _registers(low[full])
    return out


def _draw(state: np.ndarray, j) -> tuple[np.ndarray, np.ndarray]:
    """The j-th spacing (mean 1) and a 24-bit number of each element."""
    h = mix(state ^ (np.asarray(j, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)))
    return -np.log(((h >> np.uint64(24)).astype(np.float64) + 0.5) / float(1 << 40)), h & np.uint64(0xFFFFFF)


def _elements(sets, at, size, part):
    n = size[part]
    where = np.repeat(at[part] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    return mix(sets[where]), np.repeat(part, n)


def _points_in_turn(sets, at, size, part, reach, low, m) -> None:
    state, owner = _elements(sets, at, size, part)
    x = np.zeros(len(state))
    flat, j = low.reshape(-1), 0
    while len(state):
        gap, pick = _draw(state, j)
        x = x + gap / m
        ok = x <= reach[owner]
        state, owner, x = state[ok], owner[ok], x[ok]
        reg = ((pick[ok] * np.uint64(m)) >> np.uint64(24)).astype(np.int64)
        np.minimum.at(flat, owner * m + reg, x)
        j += 1


def _points_at_once(sets, at, size, part, reach, low, m) -> None:
    flat = low.reshape(-1)
    order = part[np.argsort(reach[part])]
    for some in np.array_split(order, max(1, len(order) // 16)):
        state, owner = _elements(sets, at, size, some)
        mean = m * reach[some].max()
        steps = np.arange(int(mean + 7 * math.sqrt(mean) + 12), dtype=np.uint64)
        gap, pick = _draw(state[:, None], steps[None, :])
        x = np.cumsum(gap, axis=1) / m
        row, col = np.nonzero(x <= reach[owner][:, None])
        reg = ((pick[row, col] * np.uint64(m)) >> np.uint64(24)).astype(np.int64)
        np.minimum.at(flat, owner[row] * m + reg, x[row, col])


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def likelihood(more: np.ndarray, less: np.ndarray, same: np.ndarray, na: np.ndarray, nb: np.ndarray):
    """The largest similarity that sets of these sizes can have, and the log likelihood of a similarity; it has a single peak."""
    u, v = na / (na + nb), nb / (na + nb)

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    def loglik(j):
        up, down = p(u - v * j), p(v - u * j)
        tiny = 1e-12
        return (more * np.log(np.maximum(up, tiny)) + less * np.log(np.maximum(down, tiny))
                + same * np.log(np.maximum(1 - up - down, tiny)))

    return np.minimum(u / v, v / u), loglik


def estimate(more: np.ndarray, less: np.ndarray, same: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity from register comparisons and the known set sizes."""
    hi, loglik = likelihood(more, less, same, na, nb)
    lo = np.zeros(len(hi))
    for _ in range(36):
        third = (hi - lo) / 3
        left = loglik(lo + third) < loglik(hi - third)
        lo, hi = np.where(left, lo + third, lo), np.where(left, hi, hi - third)
    return (lo + hi) / 2


def cutoff(percent: int, m: int = REGISTERS) -> float:
    t = percent / 100
    return t - SLACK * math.sqrt(t * (1 - t) / m)


def likely(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sketches may belong to linked sets; a and b are matrices of paired rows."""
    least, out = cutoff(percent), np.zeros(len(a), dtype=bool)
    same = (a == b).sum(axis=1)
    some = np.flatnonzero((same >= (least - 0.02) * a.shape[1])
                          & (np.minimum(na, nb) >= least * np.maximum(na, nb)))
    if len(some):
        more = (a[some] > b[some]).sum(axis=1)
        most, loglik = likelihood(more, a.shape[1] - same[some] - more, same[some], na[some].astype(float), nb[some].astype(float))
        # the peak, which is the estimate, lies beyond the cutoff if the likelihood still rises there
        out[some[(most >= least) & (loglik(least + 1e-7) >= loglik(least - 1e-7))]] = True
    return out


def sketch_frame(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, digest, registers) of each row; without words n is 0 and digest and registers are null."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, text = batch.column(0), batch.column(1)
        n, digest, regs = [], [], []
        for t in texts_of(text):
            keys, at = shingle_sets(words_of(t, lower=True), k)
            n.append(np.diff(at))
            rows = sketches(keys, at)
            for i in range(len(t)):
                own = keys[at[i]:at[i + 1]]
                digest.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                regs.append(rows[i].tobytes() if len(own) else None)
        return pa.RecordBatch.from_arrays([ids, pa.array(np.concatenate(n)), pa.array(digest, pa.binary()), pa.array(regs, pa.binary())],
                                          ["doc_id", "n", "digest", "registers"])
    return map_arrow(docs, run, "doc_id long, n long, digest binary, registers binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(len(column), -1)


def band_keys(nodes: DataFrame, percent: int) -> DataFrame:
    """(key, node, band) for each band of each sketch."""
    count = bands(percent)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        regs = _matrix(batch.column(1)).astype(np.uint64)
        keys = np.empty((len(regs), count), dtype=np.uint64)
        for b in range(count):
            h = np.full(len(regs), b + 1, dtype=np.uint64)
            for c in range(b * ROWS, (b + 1) * ROWS):
                h = mix(h ^ regs[:, c])
            keys[:, b] = h
        node = np.repeat(np.asarray(batch.column(0)), count)
        band = np.tile(np.arange(count, dtype=np.int32), len(regs))
        return pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(node), pa.array(band)], ["key", "node", "band"])
    return map_arrow(nodes.select("node", "registers"), run, "key long, node long, band int")


def _likely_pairs(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes whose estimate reaches the cutoff."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("registers").alias(f"r{x}"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        t = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        ok = likely(_matrix(t["ra"]), _matrix(t["rb"]), np.asarray(t["na"]), np.asarray(t["nb"]), percent)
        return pa.RecordBatch.from_arrays([t["a"].filter(pa.array(ok)), t["b"].filter(pa.array(ok))], ["a", "b"])
    return map_arrow(pairs.join(side("a"), "a").join(side("b"), "b"), run, "a long, b long")


def _rest_groups(members: DataFrame) -> DataFrame:
    """Bucket members (key, node, band, comp) dealt to groups of bounded size.

    A group has a kind: 0, all pairs of its rows; 1, pairs of a row of side 0 and one of side 1.
    Every pair of members of different components meets in exactly one group of the bucket.
    """
    per = members.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
    whole = (per.groupBy("key").agg(F.count(F.lit(1)).alias("comps"), F.sum("c").alias("all"), F.max(F.struct("c", "comp")).alias("m"))
             .where("comps > 1")
             .select("key", F.col("m.comp").alias("base"), F.ceil(F.col("m.c") / BLOCK).cast("int").alias("nb"),
                     F.greatest(F.lit(1), F.ceil((F.col("all") - F.col("m.c")) / BLOCK).cast("int")).alias("no"), "all"))
    rows = members.join(whole, "key").withColumn("is_base", F.col("comp") == F.col("base"))
    slot = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    group = lambda kind, i, j, side: F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("i"), j.cast("int").alias("j"),
                                              F.lit(side).alias("side"))
    i, j = slot("nb"), slot("no")
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    base = F.transform(upto("no"), lambda x: group(1, i, x, 0))
    cross = F.transform(upto("nb"), lambda x: group(1, x, j, 1))
    own = F.array(group(0, j, j, 0))
    others = F.transform(F.filter(upto("no"), lambda x: x != j),
                         lambda x: F.struct(F.lit(1).alias("kind"), (F.lit(-1) - F.least(x, j)).cast("int").alias("i"),
                                            F.greatest(x, j).cast("int").alias("j"), (x < j).cast("int").alias("side")))
    small = F.array(group(0, F.lit(0), F.lit(0), 0))
    groups = (F.when(F.col("all") <= BLOCK, small).when(F.col("is_base"), base)
              .otherwise(F.concat(cross, own, others)))
    return rows.select("key", "node", "band", "comp", F.explode(groups).alias("g")).select("key", "g.*", "node", "band", "comp")


def _rest_pairs(members: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that share a bucket and may be linked.

    A pair that shares several buckets comes from that of its first band alone.
    """
    def pairs(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        kind, side, band = rows["kind"][0].as_py(), np.asarray(rows["side"]), rows["band"][0].as_py()
        node, comp, n = (np.asarray(rows[c]) for c in ("node", "comp", "n"))
        regs = _matrix(rows["registers"])
        for x in range(len(node) - 1):
            ys = np.arange(x + 1, len(node))
            ys = ys[comp[ys] != comp[x]]
            if kind:
                ys = ys[side[ys] != side[x]]
            least = cutoff(percent)
            ys = ys[(np.minimum(n[ys], n[x]) >= least * np.maximum(n[ys], n[x]))]
            if len(ys) > 16:  # a look at a part of the registers rules most out
                part = slice(0, 96)
                few = (regs[ys, part] == regs[x, part]).mean(axis=1)
                ys = ys[few >= percent / 100 - (SLACK + 0.5) * math.sqrt(percent / 100 * (1 - percent / 100) / 96)]
            if len(ys):
                ok = ys[likely(np.broadcast_to(regs[x], (len(ys), regs.shape[1])), regs[ys], np.full(len(ys), n[x]), n[ys], percent)]
                if band and len(ok):
                    before = (regs[ok, :band * ROWS] == regs[x, :band * ROWS]).reshape(len(ok), band, ROWS).all(axis=2).any(axis=1)
                    ok = ok[~before]
                yield np.minimum(node[x], node[ok]), np.maximum(node[x], node[ok])

    def run(rows: pa.Table) -> pa.RecordBatch | None:
        found = [p for p in pairs(rows) if len(p[0])]
        if not found:
            return None
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([p[i] for p in found])) for i in (1, 0)], ["a", "b"])

    rows = _rest_groups(members).join(nodes.select("node", "n", "registers"), "node")
    return map_groups(rows, ["key", "kind", "i", "j"], run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest id reachable over links, its own included; ``kept`` marks the
    row whose id it is. Null and empty texts, and texts without words, have no set and no link;
    fewer than ``k`` words are one shingle. Rows that repeat an id are one node: what
    either links to, both are linked to. A row with a null id takes no part: component_id is null
    and kept is true. An empty table gives an empty table; other columns are not looked at.
    """
    named = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    all_rows = settle(sketch_frame(named, k), "sketches")
    rows = all_rows.where("doc_id is not null and n > 0")
    # written first: a join of two plain shuffles can be split where copies make a digest hot
    classes = settle(rows.groupBy("digest").agg(F.min("doc_id").alias("node")), "classes")
    member = rows.select("doc_id", "digest").join(classes, "digest").select("doc_id", "node")
    nodes = rows.join(classes.withColumnRenamed("node", "doc_id"), ["digest", "doc_id"]).select(
        F.col("doc_id").alias("node"), "n", "registers")
    keys = band_keys(nodes, percent)
    shared = settle(keys.join(keys.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
                              .select("key", "low"), "key"), "buckets")
    involved = shared.select("node").distinct()
    wanted = bitmap_filter(named.where("doc_id is not null"), "doc_id", involved, "node")
    texts = settle(wanted.withColumnRenamed("doc_id", "node").join(involved, "node").select("node", "text"), "texts")
    some = settle(nodes.join(involved, "node"), "nodes")

    star = shared.where("node <> low").select(F.col("low").alias("a"), F.col("node").alias("b")).distinct()
    links = settle(confirmed(settle(_likely_pairs(star, some, percent), "star"), texts, k, percent), "links")
    comps = components(links)
    held = (shared.select("key", "node", "band").join(comps, "node", "left")
            .select("key", "node", "band", F.coalesce("component", "node").alias("comp")))
    rest = settle(_rest_pairs(settle(held, "held"), some, percent), "rest")
    more = confirmed(rest, texts, k, percent)
    same_id = member.where("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    # the components of the stars' links stand for them: one edge a node
    known = settle(comps.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b")), "known")
    comps = components(known.unionByName(more).unionByName(same_id))
    out = all_rows.select("doc_id", F.col("n").alias("n_shingles")).join(
        comps.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    found = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", found.alias("component_id"),
                      F.coalesce(F.col("doc_id") == found, F.lit(True)).alias("kept"))
