"""Log-likelihood of whole texts under a gated recurrent language model.

Words are counted on Spark.  The most frequent ones are outputs of the model, in classes of equal
size; every other word belongs to a tail class named by its ending and has the unigram probability
of its class.  The output softmax is factored: class given state, then word given class and state; the tail
classes are the members of a few classes more, so that no softmax is wide.
The model is trained in numpy with truncated backpropagation, shard by shard on all training texts,
and the shards' parameters are averaged after every round.  Scoring runs many texts side by
side; the state is carried from window to window until a text ends.  Only bounded tables are
broadcast: counts of words beyond them are joined.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.text import carried, gathered, held, lower_words, small_batches, utf8
from cohortloom.session import durable

#: The end of a text, counted as a word; no word is empty.
END = b""
#: Words in an output class, output classes, classes of other words.
CLASS_WORDS, WORD_CLASSES, TAILS = 48, 42, 64
#: Tail classes that are members of one output class.
CLASS_TAILS = 32
#: Words whose counts are broadcast, at most: all that reach a count.
TABLE_WORDS = 1 << 17
HIDDEN = 16
#: The weights are trained on all training texts; a corpus of fewer tokens is passed over several times.
LEAST_TOKENS, MOST_PASSES = 1_500_000, 6
#: Tokens of a training shard, rounds of averaging (each with its own part of the texts), steps of a training window, step size.
SHARD_TOKENS, ROUNDS, STEPS, RATE = 8_000_000, 2, 20, 0.01
#: Least and most lanes of a training window; between them, as many as make WINDOWS windows.
LANES, MOST_LANES, WINDOWS = 48, 512, 400
#: Lanes and steps of a scoring window; rows whose logits are worked on at once, so that they stay in the cache.
SCORE_LANES, SCORE_STEPS, CACHED_ROWS = 768, 32, 2048
#: Tokens that are scored side by side, about: a run takes as many steps as its longest text has.
SCORE_TOKENS = 3 << 20

LOG10 = float(np.log(10))
#: Bytes of text that are cut into words at once; a longer text is cut alone.
TEXT_BYTES = 6 << 20


# ---- counts -----------------------------------------------------------------------------------------


def text_slices(column: pa.Array):
    """The texts in slices of TEXT_BYTES, a longer one alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = 0
    while begin < len(column):
        before = ends[begin - 1] if begin else 0
        upto = max(begin + 1, int(np.searchsorted(ends, before + TEXT_BYTES, "right")))
        yield column.slice(begin, upto - begin)
        begin = upto


def split_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """`lower_words` of all texts of a string column, one after the other, and their number in each text; null has none."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(column.fill_null("")))
    words = lists.flatten().cast(pa.binary())
    there = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # white space at an end of a text leaves an empty word
    upto = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)])
    counts = np.diff(np.concatenate([[0], np.cumsum(there)])[upto])
    return words if there.all() else words.filter(pa.array(there)), counts


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """word (binary, empty for the end of a text) and n over all rows; null is an empty text."""

    def run(batches):
        counts = None

        def rows():
            return [pa.RecordBatch.from_arrays([b.column("word"), b.column("n")], names=["word", "n"]) for b in counts.combine_chunks().to_batches()]

        for batch in gathered(batches, TEXT_BYTES):
            for column in text_slices(batch.column(0)):
                words, _ = split_words(column)
                found = words.value_counts()
                more = pa.table({"word": pa.concat_arrays([found.field(0), pa.array([END], pa.binary())]), "n": pa.concat_arrays([found.field(1), pa.array([len(column)], pa.int64())])})
                counts = more if counts is None else pa.concat_tables([counts, more])
                if len(counts) > 400_000:
                    counts = counts.group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})
                if len(counts) > 400_000:
                    yield from rows()
                    counts = None
        if counts is not None:
            counts = counts.group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})
            yield from rows()

    small_batches(docs.sparkSession)
    made = docs.select(F.col(f"`{text}`").cast("string")).mapInArrow(run, "word binary, n long")
    return made.groupBy("word").agg(F.sum("n").alias("n"))


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAILS


class Lexicon:
    """Broadcast tables: number, count, class and place of the most frequent words."""

    def __init__(self, words: list[bytes], counts: list[int], total: int, distinct: int, tail_n: np.ndarray, tail_v: np.ndarray):
        """words by descending count; tail_n and tail_v: tokens and words of each tail class."""
        self.given = words, counts, total, distinct, tail_n, tail_v
        self.words, self.counts = words, np.array(counts, float)
        self.total, self.distinct = total, distinct
        self.own = min(len(words), CLASS_WORDS * WORD_CLASSES)
        tails = np.array([tail_class(w) for w in words[self.own :]], np.int64)
        self.log_tail = np.log(tail_n + 0.5 * (tail_v + 1))
        number = np.arange(len(words))
        self.kind = np.concatenate([number[: self.own] // CLASS_WORDS, WORD_CLASSES + tails]).astype(np.int16)
        self.slot = np.where(number < self.own, number % CLASS_WORDS, 0).astype(np.int16)
        self.row = np.concatenate([number[: self.own], CLASS_WORDS * WORD_CLASSES + tails]).astype(np.int16)
        self.inside = np.concatenate([np.zeros(self.own), np.log(self.counts[self.own :] + 0.5) - self.log_tail[tails]])
        self.log_base = float(np.log(total + 0.5 * (distinct + 1)))
        self.base = np.log(self.counts + 0.5) - self.log_base
        sums = np.bincount(self.kind[: self.own], weights=self.counts[: self.own], minlength=WORD_CLASSES)[:WORD_CLASSES]
        self.class_counts = np.concatenate([sums, tail_n])


#: Input rows: own words, tail classes, and the beginning of a text.
ROWS = CLASS_WORDS * WORD_CLASSES + TAILS + 1
#: Output classes with those of the tails.
CLASSES = WORD_CLASSES + -(-TAILS // CLASS_TAILS)
#: Output class of a class of words or a tail class.
CLASS_OF = np.concatenate([np.arange(WORD_CLASSES), WORD_CLASSES + np.arange(TAILS) // CLASS_TAILS]).astype(np.int16)


# ---- model --------------------------------------------------------------------------------------------

SHAPES = {
    "input": (ROWS, 3 * HIDDEN),
    "state": (HIDDEN, 3 * HIDDEN),
    "class_w": (HIDDEN, CLASSES),
    "class_b": (CLASSES,),
    "word_w": (CLASSES, HIDDEN, CLASS_WORDS),
    "word_b": (CLASSES, CLASS_WORDS),
}


def initial(lexicon: Lexicon) -> dict[str, np.ndarray]:
    """Small random weights; the biases make it the class-factored unigram model."""
    rng = np.random.default_rng(7)
    p = {k: (rng.standard_normal(s) * 0.1).astype(np.float32) for k, s in SHAPES.items()}
    counts = np.bincount(CLASS_OF, weights=lexicon.class_counts + 0.5)
    p["class_b"] = np.log(counts / counts.sum()).astype(np.float32)
    words = np.full(WORD_CLASSES * CLASS_WORDS, 1e-9)
    words[: lexicon.own] = lexicon.counts[: lexicon.own] + 0.5
    p["word_b"] = np.zeros(SHAPES["word_b"], np.float32)
    p["word_b"][:WORD_CLASSES] = np.log(words).reshape(WORD_CLASSES, CLASS_WORDS)
    tails = np.arange(TAILS)
    p["word_b"][WORD_CLASSES + tails // CLASS_TAILS, tails % CLASS_TAILS] = np.log(lexicon.class_counts[WORD_CLASSES:] + 0.5)
    p["class_w"] *= 0.1
    p["word_w"] *= 0.1
    return p


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in SHAPES])


def unflat(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[k] = values[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return out


def step(x: np.ndarray, h: np.ndarray, state: np.ndarray):
    """One gated step; x holds the input's part of the three gates."""
    a = h @ state
    gates = x[:, : 2 * HIDDEN] + a[:, : 2 * HIDDEN]
    np.negative(gates, out=gates)
    np.exp(gates, out=gates)
    gates += 1
    np.reciprocal(gates, out=gates)
    r, z = gates[:, :HIDDEN], gates[:, HIDDEN:]
    inner = a[:, 2 * HIDDEN :]
    n = r * inner
    n += x[:, 2 * HIDDEN :]
    np.tanh(n, out=n)
    nxt = h - n
    nxt *= z
    nxt += n
    return nxt, (r, z, inner, n)


def tame(p) -> bool:
    """Whether no exponential of a logit can leave the range of its type: states are in [-1, 1], so the weights bound the logits."""
    return max(np.abs(p[f"{k}_w"]).sum(axis=-2).max() + np.abs(p[f"{k}_b"]).max() for k in ("class", "word")) < 80


def exponentials(h: np.ndarray, w: np.ndarray, b: np.ndarray, at: np.ndarray, plain: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log probability of one column of each row of h @ w + b; the exponentials of all columns, and their sums.

    Unless `plain`, the maximum of a row is taken off first.
    """
    logits = h @ w
    logits += b
    if not plain:
        logits -= logits.max(axis=1, keepdims=True)
    chosen = logits[np.arange(len(at)), at]
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], logits.dtype)
    return chosen - np.log(total), logits, total


def members(kind: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Output class, and place in it, of words and tail classes."""
    return CLASS_OF[kind], np.where(kind < WORD_CLASSES, slot, (kind - WORD_CLASSES) % CLASS_TAILS)


def width(k: int) -> int:
    """Members of an output class."""
    return CLASS_WORDS if k < WORD_CLASSES else CLASS_TAILS


def by_class(kind: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """Order of the rows by output class, and the place that each class has in it."""
    order = np.argsort(kind.astype(np.int16), kind="stable")  # sorted by digits
    ends = np.searchsorted(kind[order], np.arange(CLASSES + 1)).tolist()
    return order, [(k, slice(ends[k], ends[k + 1])) for k in range(CLASSES) if ends[k] < ends[k + 1]]


def cached(rows: slice):
    """The rows in runs of CACHED_ROWS."""
    for begin in range(rows.start, rows.stop, CACHED_ROWS):
        yield slice(begin, min(begin + CACHED_ROWS, rows.stop))


def output(p, h: np.ndarray, kind: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """Natural log of a word given the state, or of the tail class that it belongs to."""
    kind, slot = members(kind, slot)
    plain, (order, classes) = tame(p), by_class(kind)
    h, kind, slot = h[order], kind[order], slot[order]
    logp = np.empty(len(h), h.dtype)
    for own in cached(slice(0, len(h))):
        logp[own] = exponentials(h[own], p["class_w"], p["class_b"], kind[own], plain)[0]
    for k, rows in classes:
        for own in cached(rows):
            logp[own] += exponentials(h[own], p["word_w"][k, :, : width(k)], p["word_b"][k, : width(k)], slot[own], plain)[0]
    out = np.empty_like(logp)
    out[order] = logp
    return out


def lanes_of(lengths: np.ndarray, lanes: int) -> list[list[int]]:
    """Texts dealt to lanes of about equal length, longest lane first; every lane in order of dealing."""
    heap = [(0, k) for k in range(min(lanes, len(lengths)))]
    out: list[list[int]] = [[] for _ in heap]
    load = [0] * len(heap)
    for i in np.argsort(-lengths, kind="stable").tolist():
        size, k = heapq.heappop(heap)
        out[k].append(i)
        load[k] = size + int(lengths[i])
        heapq.heappush(heap, (load[k], k))
    return [out[k] for k in sorted(range(len(out)), key=lambda k: -load[k])]


def strips(lengths: np.ndarray, lanes: int):
    """Per lane: token positions (into the joined texts) and where a text begins."""
    begin = np.cumsum(lengths) - lengths
    dealt = lanes_of(lengths, lanes)
    size = np.array([lengths[own].sum() for own in dealt], np.int64)
    place = np.full((int(size.max()), len(dealt)), -1, np.int64)
    fresh = np.zeros(place.shape, bool)
    for k, own in enumerate(dealt):
        place[: size[k], k] = np.concatenate([np.arange(begin[i], begin[i] + lengths[i]) for i in own])
        starts = np.cumsum(lengths[own]) - lengths[own]
        fresh[starts, k] = True
    return place, fresh, size


def score_texts(p, rows: list[np.ndarray], kinds: list[np.ndarray], slots: list[np.ndarray]) -> np.ndarray:
    """Summed natural log of classes and own words for each text.

    rows, kinds, slots: input row, class and place of every token of a text, the end included.
    """
    return score_tokens(p, np.concatenate(rows), np.concatenate(kinds), np.concatenate(slots), np.array([len(r) for r in rows], np.int64))


def score_tokens(p, row: np.ndarray, kind: np.ndarray, slot: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """`score_texts` of texts that lie one after the other."""
    place, fresh, size = strips(lengths, SCORE_LANES)
    logp = np.zeros(len(row))
    alive, begins = np.searchsorted(-size, -np.arange(len(place)), "left").tolist(), fresh.any(axis=1).tolist()
    h = np.zeros((place.shape[1], HIDDEN), np.float32)
    before = np.full(place.shape[1], ROWS - 1)
    for begin in range(0, len(place), SCORE_STEPS):
        states, tokens = [], []
        for t in range(begin, min(begin + SCORE_STEPS, len(place))):
            h, x, now = h[: alive[t]], before[: alive[t]], place[t, : alive[t]]
            if begins[t]:
                new = fresh[t, : alive[t]]
                h = np.where(new[:, None], np.float32(0), h)  # a copy: the old states are still to be scored
                x = np.where(new, ROWS - 1, x)
            h, _ = step(p["input"].take(x, axis=0), h, p["state"])
            before = row.take(now)
            states.append(h)
            tokens.append(now)
        tokens = np.concatenate(tokens)
        logp[tokens] = output(p, np.concatenate(states), kind[tokens], slot[tokens])
    return np.add.reduceat(logp, np.cumsum(lengths) - lengths)


def train(p, rows: list[np.ndarray], kinds: list[np.ndarray], slots: list[np.ndarray], passes: int, rate: float = RATE):
    """Truncated backpropagation through windows of STEPS tokens, the state carried on; Adam steps.

    The texts in a row are cut into lanes of equal length, so every token is trained on; a lane that begins
    inside a text begins without a state.
    """
    row, kind, slot = np.concatenate(rows), np.concatenate(kinds), np.concatenate(slots)
    lengths = np.array([len(r) for r in rows], np.int64)
    lanes = min(MOST_LANES, max(LANES, len(row) // (STEPS * WINDOWS)), max(1, len(row) // STEPS))
    place, fresh = (np.full(-(-len(row) // lanes) * lanes, x) for x in (np.int32(-1), False))
    place[: len(row)] = np.arange(len(row))
    fresh[np.cumsum(lengths) - lengths] = True
    fresh |= place < 0
    place, fresh = (x.reshape(lanes, -1).T.copy() for x in (place, fresh))
    begins = fresh.any(axis=1).tolist()
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    turn, windows = 0, max(1, -(-len(place) // STEPS) * passes)
    for _ in range(passes):
        h = np.zeros((place.shape[1], HIDDEN), np.float32)
        for begin in range(0, len(place), STEPS):
            upto = min(begin + STEPS, len(place))
            saved, at = [], []
            for t in range(begin, upto):
                now = place[t]
                new = fresh[t]
                x = row.take(now - 1, mode="wrap")
                if begins[t]:
                    h = np.where(new[:, None], np.float32(0), h)
                    x = np.where(new, ROWS - 1, x)
                nxt, gates = step(p["input"].take(x, axis=0), h, p["state"])
                saved.append((x, h, gates, nxt, new))
                at.append(now)
                h = nxt
            at = np.concatenate(at)
            real = at >= 0
            g = gradients(p, saved, at, real, kind, slot)
            turn += 1
            pace = rate * (1 - 0.9 * turn / windows) * np.sqrt(1 - 0.999**turn) / (1 - 0.9**turn)
            for k in p:
                root = g[k] * g[k]
                root -= v[k]
                root *= np.float32(0.001)
                v[k] += root
                g[k] -= m[k]
                g[k] *= np.float32(0.1)
                m[k] += g[k]
                np.sqrt(v[k], out=root)
                root += np.float32(1e-8)
                np.divide(m[k], root, out=root)
                root *= np.float32(pace)
                p[k] -= root
    return p


def softmax_gradients(h: np.ndarray, w: np.ndarray, b: np.ndarray, at: np.ndarray, n: int, plain: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of a softmax for its weights, biases and states, a row having the weight 1/n."""
    _, probs, total = exponentials(h, w, b, at, plain)
    probs *= (1 / (n * total))[:, None]
    probs[np.arange(len(at)), at] -= np.float32(1 / n)
    return h.T @ probs, np.ones(len(at), probs.dtype) @ probs, probs @ w.T


def summed_rows(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sum of the rows of `values` that share a number below `size`, which is less than 32,768."""
    out = np.zeros((size, values.shape[1]), values.dtype)
    order = np.argsort(at.astype(np.int16), kind="stable")  # sorted by digits
    own = at[order]
    begin = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    out[own[begin]] = np.add.reduceat(values[order], begin, axis=0)
    return out


def gradients(p, saved, at, real, kind, slot) -> dict[str, np.ndarray]:
    """Mean gradient of the negative log-likelihood of a window."""
    n = max(1, int(real.sum()))
    h = np.concatenate([s[3] for s in saved])
    g = {k: np.zeros(s, np.float32) for k, s in SHAPES.items()}
    own = np.flatnonzero(real)
    kinds, slots = members(kind[at[own]], slot[at[own]])
    plain, (order, classes) = tame(p), by_class(kinds)
    own, kinds, slots = own[order], kinds[order], slots[order]
    states = h[own]
    back = np.empty_like(states)
    for rows in cached(slice(0, len(own))):
        w, b, back[rows] = softmax_gradients(states[rows], p["class_w"], p["class_b"], kinds[rows], n, plain)
        g["class_w"] += w
        g["class_b"] += b
    for k, rows in classes:
        columns = width(k)
        g["word_w"][k, :, :columns], g["word_b"][k, :columns], more = softmax_gradients(states[rows], p["word_w"][k, :, :columns], p["word_b"][k, :columns], slots[rows], n, plain)
        back[rows] += more
    dh = np.zeros_like(h)
    dh[own] = back
    dh = dh.reshape(len(saved), -1, HIDDEN)
    before, r, z, inner, new_state = (np.stack(x) for x in ([s[1] for s in saved], *zip(*(s[2] for s in saved))))
    # slopes of a step: of its inner state for the state, and of its gates for those
    for_inner = (1 - z) * (1 - new_state * new_state)
    for_r = inner * r * (1 - r)
    for_z = (before - new_state) * z * (1 - z)
    carry = np.zeros_like(dh[0])
    back = np.empty((len(saved), len(carry), 3 * HIDDEN), dh.dtype)
    inner_back, across = np.empty_like(dh), np.ascontiguousarray(p["state"].T)
    for t in reversed(range(len(saved))):
        d, dn, da = dh[t], inner_back[t], back[t]
        d += carry
        np.multiply(d, for_inner[t], out=dn)
        np.multiply(dn, for_r[t], out=da[:, :HIDDEN])
        np.multiply(d, for_z[t], out=da[:, HIDDEN : 2 * HIDDEN])
        np.multiply(dn, r[t], out=da[:, 2 * HIDDEN :])
        carry = da @ across
        d *= z[t]
        carry += d
        if saved[t][4].any():
            carry[saved[t][4]] = 0
    g["state"] += before.reshape(-1, HIDDEN).T @ back.reshape(-1, 3 * HIDDEN)
    back[:, :, 2 * HIDDEN :] = inner_back
    g["input"] = summed_rows(np.concatenate([s[0] for s in saved]), back.reshape(-1, 3 * HIDDEN), ROWS)
    norm = float(np.sqrt(sum((x * x).sum() for x in g.values())))
    if norm > 1:
        for k in g:
            g[k] /= norm
    return g


# ---- the job ----------------------------------------------------------------------------------------------


def _lexicon(counts: DataFrame) -> Lexicon:
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    step = F.floor(F.log2("n") * 64)  # a few thousand steps whatever the counts
    steps = sorted(((r["step"], r["words"]) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()), reverse=True)
    least, held = None, 0
    for at, words in steps:
        held += words
        if held > TABLE_WORDS:
            break
        least = at
    top = counts.where(step >= least).collect() if least is not None else []
    top.sort(key=lambda r: (-r["n"], bytes(r["word"])))
    words = [bytes(r["word"]) for r in top]
    own = set(words[: CLASS_WORDS * WORD_CLASSES])

    def run(batches):
        n, v = np.zeros(TAILS, np.int64), np.zeros(TAILS, np.int64)
        for batch in batches:
            for word, count in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if word not in own:
                    k = tail_class(word)
                    n[k] += count
                    v[k] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(TAILS), pa.int32()), pa.array(n), pa.array(v)], names=["k", "n", "v"])

    tail_n, tail_v = np.zeros(TAILS), np.zeros(TAILS)
    sums = counts.select("word", "n").mapInArrow(run, "k int, n long, v long").groupBy("k").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    for r in sums.collect():  # one row for each tail class
        tail_n[r["k"]], tail_v[r["k"]] = r["n"], r["v"]
    return Lexicon(words, [r["n"] for r in top], int(total["n"]), int(total["v"]), tail_n, tail_v)


def _batch_encoder(lexicon: Lexicon):
    """Function from a string column to the tokens of all its texts, one after the other, each text with its end.

    It gives the number of tokens of each text, their numbers in the table (-1: not there), the places and the
    words of those not there, and row, class, place of all.
    """
    table, rows_of_tail = pa.array(lexicon.words, pa.binary()), CLASS_WORDS * WORD_CLASSES
    end = lexicon.words.index(END) if END in lexicon.words else -1

    def encode(column: pa.Array):
        words, lengths = split_words(column)
        lengths = lengths + 1
        inside = np.ones(int(lengths.sum()), bool)
        inside[np.cumsum(lengths) - 1] = False
        ids = np.full(len(inside), end, np.int64)
        ids[inside] = pc.fill_null(pc.index_in(words, value_set=table), -1).to_numpy(zero_copy_only=False)
        rare = np.flatnonzero(ids < 0)
        place = np.where(inside, np.cumsum(inside) - 1, len(words))[rare]
        rare_words = pa.concat_arrays([words, pa.array([END], pa.binary())]).take(pa.array(place))
        if len(lexicon.words):
            row, kind, slot = lexicon.row[ids], lexicon.kind[ids], lexicon.slot[ids]
        else:
            row, kind, slot = (np.zeros(len(ids), np.int16) for _ in range(3))
        if len(rare):
            endings = pc.binary_slice(rare_words, -2).dictionary_encode()
            tails = np.array([tail_class(w) for w in endings.dictionary.to_pylist()], np.int64)[endings.indices.to_numpy()]
            row[rare], kind[rare], slot[rare] = rows_of_tail + tails, WORD_CLASSES + tails, 0
        return lengths, ids, rare, rare_words, row, kind, slot

    return encode


def _encoder(lexicon: Lexicon):
    """Function from a text to its words, their numbers in the table (-1: not there), places of those not there, and row, class, place."""
    encode = _batch_encoder(lexicon)

    def one(content: bytes):
        _, ids, rare, _, row, kind, slot = encode(pa.array([content], pa.binary()).view(pa.string()))
        return [*lower_words(content), END], ids, rare, row, kind, slot

    return one


def rare_lists(lengths: np.ndarray, rare: np.ndarray, words: pa.Array) -> pa.Array:
    """For each text its words that are not in the table, with the times that it has them."""
    kind = pa.struct([("word", pa.binary()), ("times", pa.int64())])
    coded = words.dictionary_encode()
    text, size = np.searchsorted(np.cumsum(lengths), rare, "right"), max(1, len(coded.dictionary))
    keys, times = np.unique(text * size + coded.indices.to_numpy().astype(np.int64), return_counts=True)
    found = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(keys % size)), pa.array(times, pa.int64())], fields=list(kind))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(keys // size, np.arange(len(lengths) + 1)), pa.int32()), found)


def fit(known: DataFrame, lexicon: Lexicon, shared, text: str = "text") -> np.ndarray:
    """Parameters after ROUNDS of local training and averaging; each shard is one task."""
    spark = known.sparkSession
    p = flat(initial(lexicon))
    if not lexicon.total:
        return p
    shards = -(-lexicon.total // SHARD_TOKENS)
    passes = max(1, min(MOST_PASSES, LEAST_TOKENS // lexicon.total))
    picked = known.select(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    picked = held(picked.repartition(shards))  # in turn, so that many copies of a text are no load of one task
    for turn in range(ROUNDS):
        now = spark.sparkContext.broadcast(p)

        def run(batches, now=now, turn=turn):
            encode = _batch_encoder(Lexicon(*shared.value))
            texts = sorted(t for batch in batches for t in utf8(batch.column(0)))
            if not texts:
                return
            order = np.random.default_rng(len(texts)).permutation(len(texts))  # the same in every round
            own = order if passes > 1 else order[turn::ROUNDS]
            if not len(own):
                return
            rows, kinds, slots = [], [], []
            chosen, texts = pa.array([texts[i] for i in own], pa.large_binary()).view(pa.large_string()), None
            for column in text_slices(chosen):
                lengths, _, _, _, *found = encode(column)
                for out, x in zip((rows, kinds, slots), found):
                    out += np.split(x, np.cumsum(lengths)[:-1])
            values = flat(train(unflat(now.value), rows, kinds, slots, passes, RATE / (1 + turn)))
            weight = float(sum(map(len, rows)))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values)), pa.int32()), pa.array(values.astype(np.float64) * weight), pa.array(np.full(len(values), weight))], names=["i", "value", "weight"])

        trained = picked.mapInArrow(run, "i int, value double, weight double").groupBy("i").agg((F.sum("value") / F.sum("weight")).alias("value"))
        found = trained.collect()  # one row for each parameter
        if found:
            p = p.copy()
            p[[r["i"] for r in found]] = [r["value"] for r in found]
    return p


def score(docs: DataFrame, known: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """`row`, n_tokens, n_known, train_tokens, base_score, score for each whole text of `docs`.

    `known` has the texts to learn from.  Null and empty texts are the end alone; repeated rows count
    and are scored each.  With nothing to learn from every word is unseen.
    """
    spark = docs.sparkSession
    counts = held(word_counts(known, text))
    lexicon = _lexicon(counts)
    shared = spark.sparkContext.broadcast(lexicon.given)  # TABLE_WORDS words at most
    weights = spark.sparkContext.broadcast(fit(known, lexicon, shared, text))
    slim = carried(docs, carry, text)
    rare_type = T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()), T.StructField("times", T.LongType())]))
    fields = [("id", T.LongType()), ("n_tokens", T.LongType()), ("n_known", T.LongType()), ("base", T.DoubleType()), ("model", T.DoubleType()), ("rare", rare_type)]
    schema = T.StructType([slim.schema["row"], *[T.StructField(n, t) for n, t in fields]])

    def run(batches):
        own = Lexicon(*shared.value)
        encode, p = _batch_encoder(own), unflat(weights.value)
        at = TaskContext.get().partitionId() << 40
        kept: list[list] = []

        def scored():
            nonlocal at
            lengths = [x[1] for x in kept]
            made = score_tokens(p, *(np.concatenate([x[k] for x in kept]) for k in (2, 3, 4)), np.concatenate(lengths))
            upto = np.cumsum([len(x) for x in lengths])
            for (rows, own_lengths, _, _, _, known_n, base, model, rare), more in zip(kept, np.split(made, upto[:-1])):
                yield pa.RecordBatch.from_arrays(
                    [rows, pa.array(np.arange(at, at + len(rows))), pa.array(own_lengths, pa.int64()), pa.array(known_n), pa.array(base), pa.array(model + more), rare],
                    names=schema.names,
                )
                at += len(rows)
            kept.clear()

        size = 0
        for batch in gathered(batches, TEXT_BYTES):
            begin = 0
            for column in text_slices(batch.column(1)):
                lengths, ids, rare, rare_words, row, kind, slot = encode(column)
                there, first = ids >= 0, np.cumsum(lengths) - lengths
                base, model = np.full(len(ids), -own.log_base), np.zeros(len(ids))
                base[there], model[there] = own.base[ids[there]], own.inside[ids[there]]
                model[rare] = -own.log_tail[kind[rare] - WORD_CLASSES]
                sums = [np.add.reduceat(x, first, dtype=t) for x, t in ((there, np.int64), (base, float), (model, float))]
                names = batch.column(0).take(pa.array(np.arange(begin, begin + len(column))))  # a copy: the batch's texts are not kept
                kept.append([names, lengths, row, kind, slot, *sums, rare_lists(lengths, rare, rare_words)])
                begin += len(column)
                size += len(ids)
                if size >= SCORE_TOKENS:
                    yield from scored()
                    size = 0
        if kept:
            yield from scored()

    made = durable(slim.mapInArrow(run, schema), "lm-scores")
    rare = made.select("id", F.explode("rare").alias("x")).select("id", "x.word", "x.times")
    found = rare.join(counts, "word", "left").groupBy("id").agg(
        F.sum(F.col("times") * F.log(F.coalesce("n", F.lit(0)) + F.lit(0.5))).alias("more"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("seen"),
    )
    whole = made.drop("rare").join(found, "id", "left")
    more = F.coalesce("more", F.lit(0.0))
    return whole.select(
        "row",
        "n_tokens",
        (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(lexicon.total).cast("long").alias("train_tokens"),
        ((F.col("base") + more) / LOG10).alias("base_score"),
        ((F.col("model") + more) / LOG10).alias("score"),
    )


def likelihood(docs: DataFrame) -> DataFrame:
    from cohortloom.llm.zstd_quality import fold

    doc = F.col("row").getField("doc_id")
    held = F.crc32(F.coalesce(doc.cast("string"), F.lit(""))) % 5 == 1
    found = score(docs, docs.where(fold("doc_id", 5) != 1), carry=["doc_id"])
    return found.select(doc.alias("doc_id"), held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
