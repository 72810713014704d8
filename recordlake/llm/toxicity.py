"""Toxicity scores from a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters the network twice: as itself (a hashed embedding) and by its characters (the sum of hashed
embeddings of its 4-byte grams, the first marked as the beginning). An embedding starts at how far its
word or gram stands out among the toxic texts of the sample, and at zero in all other components, so
that what training never saw, or saw too seldom to tell, says nothing. Two gated recurrent units read a window of words, one in
each direction; attention weighs their states, and the weighted mean gives the window's logit. A text's
windows overlap by half, all of them are scored, and the text's score is that of its highest window.

Training sees the whole of each text of its sample, but a label doesn't say which window made it: a toxic
text trains its highest window, a clean text its highest ones (they're the ones to push down). The
sample is bounded by ``SAMPLE`` texts of each label and ``MOST_CHARS`` characters a text, plus ``LONG`` longer
texts of each label of up to ``LONG_CHARS``; texts beyond that are scored, but not trained on. It is fitted once on the driver, and the weights (a few MB) go to all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from recordlake.llm.bpe import gather
from recordlake.llm.frames import map_arrow, position, settle
from recordlake.llm.textkit import VALUE_LOWER, Texts, mix, texts_of, words_of

SAMPLE = 1500
MOST_CHARS = 3000
LONG = 100
LONG_CHARS = 40_000
WINDOW = 32
STEP = 16
BUCKETS = 1 << 16
EMBED = 8
HIDDEN = 8
EPOCHS = 6
STEPS = 800
THRESHOLD = 0.3
GRAM = 4
RATE = 0.02
#: Texts of the sample that must hold a word or gram for its embedding to be trained.
LEAST = 3


@dataclass
class Coded:
    """Words of some texts as numbers of distinct words, and the distinct words' buckets."""

    word: np.ndarray
    before: np.ndarray
    bucket: np.ndarray
    gram: np.ndarray
    gram_at: np.ndarray


def code(texts: Texts) -> Coded:
    words = words_of(texts, lower=True)
    _, first, which = np.unique(words.hash, return_index=True, return_inverse=True)
    start, size = words.start[first], words.end[first] - words.start[first]
    bucket = (words.hash[first] >> np.uint64(48)).astype(np.int64)
    value = VALUE_LOWER[texts.data]
    run = np.zeros(len(value), dtype=np.uint64)
    if len(value) >= GRAM:
        for i, factor in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)):
            run[:len(value) - GRAM + 1] += value[i:len(value) - GRAM + 1 + i] * np.uint64(factor)
    inside = np.maximum(size - GRAM + 1, 0)
    at = np.concatenate([[0], np.cumsum(inside + 1)])
    gram = np.empty(at[-1], dtype=np.uint64)
    rest = np.ones(len(gram), dtype=bool)
    rest[at[:-1]] = False
    gram[rest] = mix(gather(run, start, inside))
    # the beginning: the first gram once more with a mark, or the whole of a shorter word
    gram[at[:-1]] = mix(np.where(size >= GRAM, run[np.minimum(start, max(0, len(run) - 1))] if len(run) else 0,
                                 words.hash[first]) ^ np.uint64(0x5851F42D4C957F2D))
    return Coded(which, words.before, bucket, (gram >> np.uint64(48)).astype(np.int64), at)


def windows(before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text, first word and number of words of every window; a text without words has an empty one."""
    n = np.diff(before)
    count = np.maximum(1, -(-(n - (WINDOW - STEP)) // STEP))
    text = np.repeat(np.arange(len(n)), count)
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return text, before[text] + nth * STEP, np.minimum(WINDOW, n[text] - nth * STEP)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Weights, forward and backward pass."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        e, h = 2 * EMBED, HIDDEN
        normal = lambda *s: (rng.normal(size=s) * np.sqrt(1 / s[0])).astype(np.float32)
        self.p = {f"{k}{d}": v for d in "fb" for k, v in (("w", normal(e, 3 * h)), ("u", normal(h, 3 * h)), ("c", np.zeros(3 * h, np.float32)))}
        self.p |= {"wa": normal(2 * h, h), "ba": np.zeros(h, np.float32), "va": normal(h, 1)[:, 0], "wo": normal(2 * h, 1)[:, 0], "bo": np.zeros(1, np.float32)}
        self.words = np.zeros((BUCKETS, EMBED), dtype=np.float32)
        self.grams = np.zeros((BUCKETS, EMBED), dtype=np.float32)
        self.shift = 0.0

    def inputs(self, c: Coded) -> np.ndarray:
        """The input of each distinct word."""
        if not len(c.bucket):
            return np.zeros((0, 2 * EMBED), dtype=np.float32)
        chars = np.add.reduceat(self.grams[c.gram], c.gram_at[:-1], axis=0)
        return np.tanh(np.concatenate([self.words[c.bucket], chars], axis=1))

    def _read(self, d: str, fed: np.ndarray, size: np.ndarray, keep: list | None):
        """States of one direction; fed holds the input products of each step, size the words of each window."""
        h = HIDDEN
        u = self.p["u" + d]
        state = np.zeros((fed.shape[1], h), dtype=np.float32)
        out = np.zeros((WINDOW, fed.shape[1], h), dtype=np.float32)
        for t in range(fed.shape[0]) if d == "f" else reversed(range(fed.shape[0])):
            inside = (t < size)[:, None]
            gates = _sigmoid(fed[t, :, :2 * h] + state @ u[:, :2 * h])
            z, r = gates[:, :h], gates[:, h:]
            new = np.tanh(fed[t, :, 2 * h:] + (r * state) @ u[:, 2 * h:])
            after = np.where(inside, z * state + (1 - z) * new, state)
            if keep is not None:
                keep.append((t, inside, z, r, new, state))
            state = after
            out[t] = after
        return out

    def forward(self, x: np.ndarray, word: np.ndarray, first: np.ndarray, size: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """The logit of each window."""
        steps = max(1, int(size.max(initial=0)))
        at = np.minimum(first[None, :] + np.arange(steps)[:, None], max(0, len(word) - 1))
        inside = np.arange(steps)[:, None] < size[None, :]
        which = np.where(inside, word[at] if len(word) else 0, len(x))
        states = []
        for d in "fb":
            # the products of a word's input are made once for each distinct word
            table = np.concatenate([x @ self.p["w" + d] + self.p["c" + d], np.zeros((1, 3 * HIDDEN), np.float32)])
            states.append(self._read(d, table[which], size, None if keep is None else keep.setdefault(d, []))[:steps])
        both = np.concatenate(states, axis=2)
        seen = np.tanh(both @ self.p["wa"] + self.p["ba"])
        weight = np.where(inside, seen @ self.p["va"], -1e9)
        weight = np.exp(weight - weight.max(axis=0)) * inside
        weight /= np.maximum(weight.sum(axis=0), 1e-9)
        pooled = (weight[:, :, None] * both).sum(axis=0)
        if keep is not None:
            keep.update(both=both, seen=seen, weight=weight, pooled=pooled, which=which)
        return pooled @ self.p["wo"] + self.p["bo"][0]

    def backward(self, x: np.ndarray, size: np.ndarray, keep: dict, d_logit: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the weights and of the distinct words' inputs."""
        p, h, g = self.p, HIDDEN, {}
        both, seen, weight, pooled, which = (keep[k] for k in ("both", "seen", "weight", "pooled", "which"))
        g["wo"], g["bo"] = pooled.T @ d_logit, d_logit.sum(keepdims=True)
        d_pooled = d_logit[:, None] * p["wo"]
        d_both = weight[:, :, None] * d_pooled
        d_weight = (both * d_pooled).sum(axis=2)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["va"] = np.einsum("tbh,tb->h", seen, d_score)
        d_seen = d_score[:, :, None] * p["va"] * (1 - seen ** 2)
        g["wa"], g["ba"] = np.einsum("tbi,tbj->ij", both, d_seen), d_seen.sum(axis=(0, 1))
        d_both = d_both + d_seen @ p["wa"].T
        d_x = np.zeros((len(x) + 1, x.shape[1]), dtype=np.float32)
        for i, d in enumerate("fb"):
            u, d_state = p["u" + d], np.zeros((both.shape[1], h), dtype=np.float32)
            d_fed = np.zeros((both.shape[0], both.shape[1], 3 * h), dtype=np.float32)
            d_u = np.zeros_like(u)
            for t, inside, z, r, new, state in reversed(keep[d]):
                d_after = d_state + d_both[t, :, i * h:(i + 1) * h]
                d_in = np.where(inside, d_after, 0)
                d_new = d_in * (1 - z) * (1 - new ** 2)
                back = d_new @ u[:, 2 * h:].T
                d_gates = np.concatenate([d_in * (state - new) * z * (1 - z), back * state * r * (1 - r)], axis=1)
                d_u[:, 2 * h:] += (r * state).T @ d_new
                d_u[:, :2 * h] += state.T @ d_gates
                d_fed[t] = np.concatenate([d_gates, d_new], axis=1)
                d_state = np.where(inside, d_after * z, d_after) + back * r + d_gates @ u[:, :2 * h].T
            flat, of = d_fed.reshape(-1, 3 * h), which.reshape(-1)
            per_word = np.zeros((len(x) + 1, 3 * h), dtype=np.float32)
            np.add.at(per_word, of, flat)
            per_word[-1] = 0
            g["u" + d], g["w" + d], g["c" + d] = d_u, x.T @ per_word[:-1], per_word[:-1].sum(axis=0)
            d_x[:-1] += per_word[:-1] @ p["w" + d].T
        return g, d_x[:-1]

    def logits(self, c: Coded, at_once: int = 4096) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The logits of all windows, and the windows."""
        text, first, size = windows(c.before)
        x, out = self.inputs(c), np.empty(len(text), dtype=np.float32)
        for lo in range(0, len(text), at_once):
            s = slice(lo, lo + at_once)
            out[s] = self.forward(x, c.word, first[s], size[s])
        return out, text, first, size

    def scores(self, texts: Texts) -> np.ndarray:
        """A score from 0 to 1 for each text: that of its highest window."""
        logit, text, _, _ = self.logits(code(texts))
        top = np.maximum.reduceat(logit, np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]])))
        return _sigmoid(top.astype(np.float64) + self.shift)


def _stands_out(text: np.ndarray, bucket: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each bucket, by how many deviations more (or fewer) toxic texts hold it than clean ones suggest,
    and whether enough texts hold it to learn from."""
    pairs = np.unique(text * BUCKETS + bucket)
    y, b = labels[pairs // BUCKETS], pairs % BUCKETS
    toxic = np.bincount(b[y == 1], minlength=BUCKETS)
    awaited = np.bincount(b[y == 0], minlength=BUCKETS) * (labels.sum() / max(1, (labels == 0).sum()))
    z = (toxic - awaited) / np.sqrt(toxic + awaited + 2)
    return np.sign(z) * np.clip(np.abs(z) - 1, 0, 3), np.bincount(b, minlength=BUCKETS) >= LEAST


def _first_look(net: Network, c: Coded, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The most that a word of each window stands out, before anything is trained."""
    mark = net.words[c.bucket, 0] + np.add.reduceat(net.grams[c.gram, 0], c.gram_at[:-1])
    flat = gather(mark[c.word], first, np.maximum(size, 0))
    out = np.full(len(first), -1.0)
    some = size > 0
    out[some] = np.maximum.reduceat(flat, (np.cumsum(size) - size)[some])
    return out


def train(texts: list[str], labels: np.ndarray, seed: int = 11) -> Network:
    """Fits a network; without texts of both labels it scores everything the same."""
    net, rng = Network(seed), np.random.default_rng(seed)
    labels = np.asarray(labels, dtype=np.int64)
    if not len(texts) or labels.min() == labels.max():
        net.p["wo"][:] = 0
        net.shift = 5.0 if len(texts) and labels.max() else -5.0
        return net
    whole = next(texts_of(pa.array(texts, pa.large_string()), rows=len(texts), chunk=1 << 62))
    c = code(whole)
    text, first, size = windows(c.before)
    y = labels[text]
    owner = np.repeat(np.arange(len(texts)), np.diff(c.before))
    n_grams = np.diff(c.gram_at)[c.word]
    marks, use_word = _stands_out(owner, c.bucket[c.word], labels)
    net.words[:, 0] = marks / 2
    marks, use_gram = _stands_out(np.repeat(owner, n_grams), gather(c.gram, c.gram_at[c.word], n_grams), labels)
    net.grams[:, 0] = marks / 2
    sums, squares = ({k: np.zeros_like(v) for k, v in net.p.items()} for _ in range(2))
    word_seen, gram_seen = np.full(BUCKETS, 1e-8, np.float32), np.full(BUCKETS, 1e-8, np.float32)
    step = 0
    epoch = 0
    while epoch < EPOCHS or step < STEPS:  # small samples are read more often
        logit = net.logits(c)[0] if epoch else _first_look(net, c, first, size)
        # the highest window of each text, and clean windows that stand out
        order = np.lexsort((-logit, text))
        rank = np.arange(len(text)) - np.searchsorted(text[order], text[order])
        top = order[rank == 0]
        clean = order[(rank > 0) & (rank < 4) & (y[order] == 0)]
        chosen = np.concatenate([top[y[top] == 1], top[y[top] == 0], clean])
        rng.shuffle(chosen)
        weight = np.where(y == 1, 0.5 / max(1, (y[chosen] == 1).sum()), 0.5 / max(1, (y[chosen] == 0).sum())) * len(chosen)
        for lo in range(0, len(chosen), 64):
            b = chosen[lo:lo + 64]
            used = np.unique(gather(c.word, first[b], size[b]))
            x_of = np.zeros(len(c.bucket), dtype=np.int64)
            x_of[used] = np.arange(len(used))
            n = c.gram_at[used + 1] - c.gram_at[used]
            small = Coded(x_of[c.word], c.before, c.bucket[used], gather(c.gram, c.gram_at[used], n), np.concatenate([[0], np.cumsum(n)]))
            x, keep = net.inputs(small), {}
            out = net.forward(x, small.word, first[b], size[b], keep)
            d = ((_sigmoid(out) - y[b]) * weight[b] / len(b)).astype(np.float32)
            g, d_x = net.backward(x, size[b], keep, d)
            step += 1
            for k, v in g.items():  # Adam for the weights
                sums[k] = 0.9 * sums[k] + 0.1 * v
                squares[k] = 0.99 * squares[k] + 0.01 * v * v
                net.p[k] -= (0.01 * (sums[k] / (1 - 0.9 ** step)) / (np.sqrt(squares[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
            d_x = d_x * (1 - x ** 2)
            for table, seen, use, rows, grad in ((net.words, word_seen, use_word, small.bucket, d_x[:, :EMBED]),
                                                 (net.grams, gram_seen, use_gram, small.gram, np.repeat(d_x[:, EMBED:], n, axis=0))):
                rows, grad = rows[use[rows]], grad[use[rows]]  # Adagrad for what occurs often enough
                own, back = np.unique(rows, return_inverse=True)
                total = np.zeros((len(own), EMBED), dtype=np.float32)
                np.add.at(total, back, grad)
                seen[own] += (total ** 2).mean(axis=1)
                table[own] -= RATE * total / np.sqrt(seen[own])[:, None]
        epoch += 1
    # the cut that tells the labels apart best becomes the threshold
    logit = net.logits(c)[0]
    top = np.maximum.reduceat(logit, np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]])))
    order = np.argsort(-top)
    hits = np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + labels.sum())
    best = int(f1.argmax())
    last = top[order[best]]
    # unseen texts stand out more than trained ones, so the cut lies near the toxic side of the gap
    cut = last - (last - top[order[best + 1]] if best + 1 < len(order) else 4.0) / 4
    net.shift = float(np.log(THRESHOLD / (1 - THRESHOLD)) - cut)
    return net


def held_out(id: str = "doc_id"):
    """Rows whose labels training never sees: crc32 of the id as text, modulo 4, is 2. Null ids are held out."""
    return F.coalesce(F.crc32(F.col(f"`{id}`").cast("string")) % 4 == 2, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], np.ndarray]:
    """A bounded sample of labelled texts, the same for the same tables: smallest hashes of the ids first."""
    # of an id with several labels the greatest counts, in every run
    known = labels.where(F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # ids are chosen without their texts; then the texts of the chosen few are picked where they are read
    rows = docs.where("text is not null").select("doc_id", F.length("text").alias("size")).join(known, "doc_id")
    kinds = [(F.col("toxic") == label) & size for size in (F.col("size") <= MOST_CHARS, F.col("size").between(MOST_CHARS + 1, LONG_CHARS))
             for label in (1, 0)]
    rows = settle(rows.groupBy("doc_id", "toxic").agg(F.min("size").alias("size")), "labelled")
    chosen = [rows.where(kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for kind, most in zip(kinds, (SAMPLE, SAMPLE, LONG, LONG))]
    ids = settle(reduce(DataFrame.unionByName, chosen), "sample")  # at most 2 * (SAMPLE + LONG) rows
    texts = (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").where(F.length("text") == F.col("size"))
             .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).orderBy("toxic", F.xxhash64("doc_id"), "doc_id").collect())
    return [r.text for r in texts], np.array([r.toxic for r in texts], dtype=np.int64)


def fit(docs: DataFrame, labels: DataFrame) -> Network:
    return train(*labelled_sample(docs, labels))


def score(df: DataFrame, net: Network, text: str = "text", to: str = "score") -> DataFrame:
    """``df`` with a score from 0 to 1 for each whole text. Null is the empty text, which has a score too.

    Every row and column stays; an input column called ``to`` is replaced.
    """
    out = df.drop(to)
    sent = df.sparkSession.sparkContext.broadcast(net)
    at = position(out, text)
    work = out.toDF(*(f"c{i}" for i in range(len(out.columns))))
    schema = StructType([*work.schema.fields, StructField("made", DoubleType())])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for t in texts_of(batch.column(at)):
            own = batch.slice(t.first, len(t))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(sent.value.scores(t))], schema.names)
    return map_arrow(work, run, schema).toDF(*out.columns, to)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of ``docs``, by a network fitted to ``labels``."""
    rows = score(docs.select("doc_id", "text"), fit(docs, labels)).select("doc_id", "score")
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
