"""Scores of texts by a log-bilinear language model trained with noise-contrastive estimation.

The context vector is a sum of the two previous words' vectors, each times its place's weights (a diagonal matrix). A word's probability
is that of its class times that of the word in its class, and both are log-bilinear: a logit is the product of the
context vector with a target vector, plus a bias. The ``frequent`` most frequent words of the training texts, the end
of a text among them and no word seen once, have vectors of their own, as context and as target; a class is a run of them by frequency.
All other words share one class and one context vector; within it the corpus counts of every word decide, so the
model is normalised over all words and one unseen.

Training goes in rounds, each over its own part of the texts. A round deals its texts by hash to groups of some 4 million
tokens, so neither the model nor its traffic depends on how the input is split over files. Every group trains on all its
texts from the same start, and each row of the parameters is averaged over the groups that changed it, weighted by how often.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailrace.llm.tables import Tables, slices
from tailrace.llm.words import Words, utf8

END = np.uint64(0x0E0DE0DE0DE0DE0D)  # stands for the end of a text among word hashes
_SLICE = 4 << 20
_BUCKET_BITS = 18
_BUCKET_SHIFT = np.uint64(64 - _BUCKET_BITS)
_HELD = 4 << 20  # entries a task holds before it hands counts on
_NOISE = 32  # classes
_WORD_NOISE = 8  # words of the class
_GROUP = 8  # triples of a class that share their noise words
_BATCH = 2048
_STEPS = 128  # at least, in a round of a group; little text goes in smaller batches
_SHORT_RUN = 4  # rows of a sum that are added side by side with those of others
_BLOCK = 1024  # contexts whose products with a class's words are held at once
_ROUNDS = 3
_GROUP_TOKENS = 4 << 20  # training tokens of a group in a round
_SIZE = 32
_HEAVY = 2.0  # times the mean weight
_ROWS = 1024  # of the parameters, in a record that tells how they changed
_CHANGES = "block int, salt int, at binary, weight binary, square binary, change binary"


@dataclass
class Vocabulary:
    """Frequent words: hashes in order and their numbers, which go from 1 by falling count (0: all other words)."""

    words: np.ndarray
    numbers: np.ndarray
    counts: np.ndarray  # of the frequent words, by number
    per_class: int  # words in each class but the first, which is that of all other words
    share: np.ndarray  # of each class among the training tokens
    total: int  # training tokens
    distinct: int
    rest_total: int  # training tokens that are not frequent words
    rest_distinct: int

    def class_of(self, numbers: np.ndarray) -> np.ndarray:
        return (numbers + self.per_class - 1) // self.per_class

    def number(self, tokens: np.ndarray) -> np.ndarray:
        """Number of each token, 0 if it is no frequent word."""
        out = np.zeros(tokens.size, np.int64)
        if not self.words.size:
            return out
        first = self._buckets()
        bucket = (tokens >> _BUCKET_SHIFT).view(np.int64)
        at, until = first.take(bucket), first.take(bucket + 1)
        left = np.flatnonzero(at < until)
        tokens, at, until = tokens[left], at[left], until[left]
        while left.size:
            word = self.words.take(at)
            found = word == tokens
            out[left[found]] = self.numbers.take(at[found])
            more = np.flatnonzero((word < tokens) & (at + 1 < until))
            left, tokens, at, until = left[more], tokens[more], at[more] + 1, until[more]
        return out

    def _buckets(self) -> np.ndarray:
        """Where the words of each bucket begin, which share their first bits; hashes fill buckets evenly."""
        if not hasattr(self, "_first"):
            ends = np.arange(1, 1 << _BUCKET_BITS, dtype=np.uint64) << _BUCKET_SHIFT
            self._first = np.concatenate(([0], np.searchsorted(self.words, ends), [self.words.size])).astype(np.int32)
        return self._first


class Texts:
    """Token hashes of a slice of texts, each text closed by END, and where each begins."""

    def __init__(self, column: pa.Array):
        found = Words(*utf8(column))
        count = np.diff(found.first) + 1
        self.first = np.concatenate(([0], np.cumsum(count)))
        self.tokens = np.empty(self.first[-1], np.uint64)
        ends = self.first[1:] - 1
        own = np.ones(self.tokens.size, bool)
        own[ends] = False
        self.tokens[own], self.tokens[ends] = found.hashes, END
        self.rows = np.repeat(np.arange(count.size), count)

    def contexts(self, numbers: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the previous word and of the one before; ``start`` before a text."""
        out = []
        for back in (1, 2):
            c = np.full(numbers.size, start)
            c[back:] = numbers[:-back]
            for j in range(back):
                at = self.first[:-1] + j
                c[at[at < self.first[1:]]] = start
            out.append(c)
        return out[0], out[1]


def _merge_counts(words: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(np.concatenate(words), return_inverse=True)
    return keys, np.bincount(where, np.concatenate(counts)).astype(np.int64)


def token_counts(texts: DataFrame) -> DataFrame:
    """word (hash) and c, its number in all texts; combined in each task before the shuffle."""

    def run(batches):
        words, counts, held = [], [], 0

        def out():
            keys, sums = _merge_counts(words, counts)
            words.clear(), counts.clear()
            for a in range(0, keys.size, 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(keys[a : a + (1 << 16)].view(np.int64)), pa.array(sums[a : a + (1 << 16)])], ["word", "n"])

        for batch in slices(batches, "text", _SLICE):
            keys, sums = np.unique(Texts(batch.column("text")).tokens, return_counts=True)
            words.append(keys), counts.append(sums)
            held += keys.size
            if held > _HELD:
                merged = _merge_counts(words, counts)
                words[:], counts[:], held = [merged[0]], [merged[1]], merged[0].size
                if held > _HELD // 2:
                    yield from out()
                    held = 0
        if words:
            yield from out()

    return texts.select("text").mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("c"))


def vocabulary(counts: DataFrame, classes: int, frequent: int) -> Vocabulary:
    """The ``frequent`` most frequent words (a bounded table) and the totals of all.

    A word seen once is left to the shared class, from which the model learns how likely a word unseen is.
    """
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = counts.where("c > 1").orderBy(F.desc("c"), "word").limit(frequent).toArrow().to_pydict()
    words, n = np.array(top["word"], np.int64).view(np.uint64), np.array(top["c"], np.int64)
    per_class = max(1, -(-words.size // (classes - 1)))
    rest = int(total) - int(n.sum())
    starts = np.arange(0, words.size, per_class)
    share = np.concatenate(([rest], np.add.reduceat(n, starts) if starts.size else [])) + 0.1
    order = np.argsort(words)
    return Vocabulary(words[order], order + 1, n, per_class, share / share.sum(), int(total), int(distinct), rest, int(distinct) - words.size)


class Model:
    """Context vectors (the last for the start of a text), weights per context place, target vectors of classes and words.

    The last entry of a target vector is its bias.
    """

    def __init__(self, words: Vocabulary):
        rng = np.random.default_rng(7)
        v, m = words.counts.size, words.share.size
        self.words = words
        own = words.class_of(np.arange(1, v + 1))
        held = np.bincount(own, words.counts, minlength=m)
        self.log_in_class = np.log(words.counts / held[own]).astype(np.float32)
        self.until = np.concatenate(([0], np.cumsum(words.counts)))
        self.share_until = np.cumsum(words.share)
        self.parts = [
            rng.normal(0, 0.1, (v + 2, _SIZE)), np.ones((_SIZE, 1)), np.full((_SIZE, 1), 0.5),
            np.column_stack([np.zeros((m, _SIZE)), np.log(words.share)]),
            np.column_stack([np.zeros((v, _SIZE)), self.log_in_class]),
        ]
        self.parts = [p.astype(np.float32) for p in self.parts]
        self.squares = [np.ones(len(p), np.float32) for p in self.parts]
        self.changes = [np.zeros(len(p)) for p in self.parts]

    def _add(self, part: int, rows: np.ndarray, g: np.ndarray, rate: float, in_order: bool = False) -> None:
        """Adds the gradients of some rows, a row's step scaled by the squares of its gradients so far."""
        if not rows.size:
            return
        order = None
        if not in_order:
            keys = np.sort(rows << 32 | np.arange(rows.size))  # quicker than a stable argsort
            rows, order = keys >> 32, keys & 0xFFFFFFFF
        start = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
        row, times = rows[start], np.diff(np.concatenate((start, [rows.size])))
        g = np.add.reduceat(g, start) if in_order else _run_sums(g, order, start, times)
        self._move(part, row, g, times, rate)

    def _move(self, part: int, row: np.ndarray, g: np.ndarray, times, rate: float) -> None:
        """Moves distinct rows along their gradients, which are overwritten."""
        square = self.squares[part].take(row) + np.einsum("ij,ij->i", g, g) / g.shape[1]
        self.squares[part][row] = square
        g *= (rate / np.sqrt(square))[:, None]
        g += self.parts[part].take(row, axis=0)
        self.parts[part][row] = g
        self.changes[part][row] += times

    def step(self, c1, c2, word, weight, rng, rate: float) -> None:
        """One noise-contrastive step on triples in order of their class.

        The true class stands against classes that the batch shares, the true word against words of its class that up to
        ``_GROUP`` triples of this class share, so that all products are dense.
        """
        e, m1, m2, qc, qw = self.parts
        share, per = self.words.share, self.words.per_class
        v1, v2 = e.take(c1, axis=0), e.take(c2, axis=0)
        r = np.ones((word.size, _SIZE + 1), np.float32)
        np.add(v1 * m1.T, v2 * m2.T, out=r[:, :_SIZE])
        own = self.words.class_of(word)
        noise = np.sort(np.searchsorted(self.share_until, rng.random(_NOISE) * self.share_until[-1], "right"))
        noise = np.minimum(noise, share.size - 1)
        log_noise = (np.log(share) + np.log(_NOISE)).astype(np.float32)
        q_own = qc.take(own, axis=0)
        true = np.einsum("ij,ij->i", r, q_own) - log_noise[own]
        false = r @ qc[noise].T - log_noise[noise]
        up = weight / (1 + np.exp(np.clip(true, -30, 30)))
        down = -weight[:, None] / (1 + np.exp(np.clip(-false, -30, 30)))
        dr = up[:, None] * q_own + down @ qc[noise]
        at = int(np.searchsorted(own, 1))  # where the shared class ends
        if per > 1 and at < own.size:
            self._step_words(word[at:] - 1, own[at:], r[at:], weight[at:], dr[at:], rng, rate)
        self._add(3, own, up[:, None] * r, rate, in_order=True)
        self._add(3, noise, down.T @ r, rate, in_order=True)
        dr = dr[:, :_SIZE]
        both = np.empty((2 * word.size, _SIZE), np.float32)
        np.multiply(dr, m1.T, out=both[: word.size])
        np.multiply(dr, m2.T, out=both[word.size :])
        self._add(0, np.concatenate((c1, c2)), both, rate)
        for part, v in ((1, v1), (2, v2)):
            self._move(part, np.arange(_SIZE), np.einsum("ij,ij->j", v, dr)[:, None], 1, rate)

    def _step_words(self, word, own, r, weight, dr, rng, rate: float) -> None:
        """The part of a step that tells a word from others of its class; adds to ``dr`` in place."""
        qw, per, width = self.parts[4], self.words.per_class, r.shape[1]
        first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        size = np.diff(np.concatenate((first, [own.size])))
        rank = np.arange(own.size) - np.repeat(first, size)
        leads = rank % _GROUP == 0
        head = np.flatnonzero(leads)
        place = (np.cumsum(leads) - 1) * _GROUP + rank % _GROUP
        source = np.full(head.size * _GROUP, own.size)  # the row of zeros, of no weight, where a group is not full
        source[place] = np.arange(own.size)
        held = np.concatenate((r, np.zeros((1, width), np.float32))).take(source, axis=0).reshape(head.size, _GROUP, width)
        held_weight = np.append(weight, np.float32(0)).take(source).reshape(head.size, _GROUP, 1)
        low = (own[head] - 1) * per
        low, high = self.until[low], self.until[np.minimum(low + per, qw.shape[0])]
        u = low[:, None] + (rng.random((head.size, _WORD_NOISE)) * (high - low)[:, None]).astype(np.int64)
        noise = self._word_at(u.ravel(), np.repeat((own[head] - 1) * per, _WORD_NOISE))
        prior = np.float32(np.log(_WORD_NOISE))
        q_own, q = qw.take(word, axis=0), qw.take(noise, axis=0).reshape(head.size, _WORD_NOISE, width)
        true = np.einsum("ij,ij->i", r, q_own) - (self.log_in_class[word] + prior)
        false = np.matmul(held, q.transpose(0, 2, 1)) - (self.log_in_class[noise] + prior).reshape(head.size, 1, _WORD_NOISE)
        up = weight / (1 + np.exp(np.clip(true, -30, 30)))
        down = -held_weight / (1 + np.exp(np.clip(-false, -30, 30)))
        dr += up[:, None] * q_own + np.matmul(down, q).reshape(-1, width).take(place, axis=0)
        back = np.matmul(down.transpose(0, 2, 1), held).reshape(-1, width)
        self._add(4, np.concatenate((word, noise)), np.concatenate((up[:, None] * r, back)), rate)

    def _word_at(self, u: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The word that holds the token ``u`` among all in order of words; ``word`` is the first of its class."""
        last = self.until.size - 2
        for step in (1 << i for i in reversed(range(self.words.per_class.bit_length()))):
            further = np.minimum(word + step, last)
            word = np.where(self.until.take(further) <= u, further, word)
        return word

    def train(self, keys: np.ndarray, counts: np.ndarray, rng, rate: float = 0.05) -> None:
        """One pass over distinct (before, previous, word) triples in random order, weighted by their counts."""
        m = self.words.counts.size + 1
        weight = counts / counts.mean()
        copies = np.ceil(weight / _HEAVY).astype(np.int64)  # a heavy triple goes into several steps, in equal parts
        order = rng.permutation(np.repeat(np.arange(keys.size), copies))
        keys, weight = keys[order], (weight / copies)[order].astype(np.float32)
        batch = min(_BATCH, max(1, keys.size // _STEPS))
        for a in range(0, keys.size, batch):
            k = keys[a : a + batch]
            by_class = np.argsort(k % m, kind="stable")  # classes are runs of words
            k, w = k[by_class], weight[a : a + batch][by_class]
            self.step(k // m % (m + 1), k // m // (m + 1), k % m, w, rng, rate)

    def changed(self, start: Model, salt: int):
        """How training from ``start`` changed each row: batches of ``_CHANGES``, in blocks of rows over all parts."""
        begin = 0
        for p, old, square, n in zip(self.parts, start.parts, self.squares, self.changes):
            rows = np.flatnonzero(n)
            change = np.zeros((rows.size, _SIZE + 1), np.float32)
            change[:, : p.shape[1]] = p[rows] - old[rows]
            yield from _records(rows + begin, n[rows], square[rows], change, salt)
            begin += len(p)

    def load(self, changes: pa.Table) -> None:
        """Takes the mean changes of a round."""
        begin = np.cumsum([0, *map(len, self.parts)])
        for block, at, _, square, change in _read(changes):
            rows = block * _ROWS + at
            for part, (p, a, b) in enumerate(zip(self.parts, begin, begin[1:])):
                here = (rows >= a) & (rows < b)
                self.squares[part][rows[here] - a] = square[here]
                p[rows[here] - a] += change[here, : p.shape[1]]

    def log_probs(self, c1: np.ndarray, c2: np.ndarray, word: np.ndarray) -> np.ndarray:
        """log10 probability of each word after the words ``c2``, ``c1``; of the shared class for word 0."""
        e, m1, m2, qc, qw = self.parts
        per, starts = self.words.per_class, self.words.counts.size + 2
        pairs, which = np.unique(c2 * starts + c1, return_inverse=True)
        r = np.ones((pairs.size, _SIZE + 1), np.float32)
        z = np.empty(pairs.size, np.float32)
        em1, em2 = self._products()
        room = np.empty((_BLOCK, max(per, qc.shape[0])), np.float32)
        for a in range(0, pairs.size, _BLOCK):
            k = pairs[a : a + _BLOCK]
            r[a : a + _BLOCK, :_SIZE] = em1[k % starts] + em2[k // starts]
            z[a : a + _BLOCK] = _log_sums(r[a : a + _BLOCK], qc, room)
        own = self.words.class_of(word)
        order = np.argsort(own.astype(np.uint16 if qc.shape[0] <= 1 << 16 else np.int64), kind="stable")
        edges = np.searchsorted(own[order], np.arange(qc.shape[0] + 1))
        out = np.empty(word.size, np.float32)
        for c, (a, b) in enumerate(zip(edges.tolist(), [*edges[1:].tolist(), word.size])):
            inside = None
            if c and per > 1:
                pair, where = np.unique(which[order[a:b]], return_inverse=True)  # words of a class often follow the same two words
                targets = qw[(c - 1) * per : c * per]
                inside = np.concatenate([_log_sums(r.take(pair[i : i + _BLOCK], axis=0), targets, room) for i in range(0, pair.size, _BLOCK)] or [z[:0]])
            for i in range(a, b, _BLOCK):
                at = order[i : min(b, i + _BLOCK)]
                r_at = r.take(which[at], axis=0)
                out[at] = r_at @ qc[c] - z[which[at]]
                if inside is not None:
                    out[at] += np.einsum("ij,ij->i", r_at, qw.take(word[at] - 1, axis=0)) - inside[where[i - a : i - a + at.size]]
        return out.astype(np.float64) / np.log(10)

    def _products(self) -> tuple[np.ndarray, np.ndarray]:
        if not hasattr(self, "_held"):
            self._held = self.parts[0] * self.parts[1].T, self.parts[0] * self.parts[2].T
        return self._held


def _run_sums(g: np.ndarray, order: np.ndarray, start: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``g``, taken in ``order``, over runs. Most runs are short and added up side by side."""
    out = g.take(order[start], axis=0)
    for nth in range(1, _SHORT_RUN):
        longer = np.flatnonzero(times > nth)
        if not longer.size:
            return out
        out[longer] += g.take(order[start[longer] + nth], axis=0)
    longer = np.flatnonzero(times > _SHORT_RUN)
    if longer.size:
        left = times[longer] - _SHORT_RUN
        begin = np.cumsum(left) - left
        at = np.repeat(start[longer] + _SHORT_RUN - begin, left) + np.arange(left.sum())
        out[longer] += np.add.reduceat(g.take(order[at], axis=0), begin)
    return out


def _log_sums(r: np.ndarray, q: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Logarithm of the sum of exp(r_i q_j) over all j, for each i; ``room`` holds the products."""
    x = room.ravel()[: len(r) * len(q)].reshape(len(r), len(q))
    np.matmul(r, q.T, out=x)
    with np.errstate(over="ignore", divide="ignore"):
        np.exp(x, out=x)
        out = np.log(x @ np.ones(len(q), np.float32))
    wrong = np.flatnonzero(~(np.abs(out) < 60))  # too large or too small for single precision
    if wrong.size:
        x = r[wrong].astype(np.float64) @ q.T
        top = x.max(axis=1)
        out[wrong] = np.log(np.exp(x - top[:, None]).sum(axis=1)) + top
    return out


def _records(rows: np.ndarray, weight: np.ndarray, square: np.ndarray, change: np.ndarray, salt: int):
    """Batches of ``_CHANGES`` for ascending rows; changes in half precision."""
    if not rows.size:
        return
    cut = np.concatenate(([0], np.flatnonzero(np.diff(rows // _ROWS)) + 1, [rows.size]))
    columns = [(rows % _ROWS).astype("<u2"), weight.astype("<f4"), square.astype("<f4"), change.astype("<f2")]
    for a, b in zip(cut, cut[1:]):
        packed = [pa.array([c[a:b].tobytes()], pa.binary()) for c in columns]
        numbers = [pa.array([int(x)], pa.int32()) for x in (rows[a] // _ROWS, salt)]
        yield pa.RecordBatch.from_arrays([*numbers, *packed], ["block", "salt", "at", "weight", "square", "change"])


def _read(changes: pa.RecordBatch | pa.Table):
    names = ("block", "at", "weight", "square", "change")
    for block, *packed in zip(*(changes.column(c).to_pylist() for c in names)):
        at, weight, square, change = (np.frombuffer(x, t) for x, t in zip(packed, ("<u2", "<f4", "<f4", "<f2")))
        yield block, at.astype(np.int64), weight, square, change.astype(np.float32).reshape(at.size, -1)


def _mean_changes(changes: DataFrame, *keys: str) -> DataFrame:
    """One record per block in each task, the weighted mean of all that came to it; tasks get whole ``keys``."""

    def run(batches):
        sums = {}
        for batch in batches:
            for block, at, weight, square, change in _read(batch):
                total = sums.setdefault(block, np.zeros((_ROWS, change.shape[1] + 2)))
                total[at] += np.column_stack([np.ones(at.size), square, change]) * weight[:, None]
        for block, total in sums.items():
            at = np.flatnonzero(total[:, 0])
            mean = total[at, 1:] / total[at, :1]
            yield from _records(block * _ROWS + at, total[at, 0], mean[:, 0], mean[:, 1:], 0)

    return changes.repartition(*keys).mapInArrow(run, _CHANGES)


def trained(texts: DataFrame, words: Vocabulary, tables: Tables) -> Model:
    """The model after all rounds; ``texts`` has doc_id and text, whose hash tells a text's round and group."""
    model = Model(words)
    deal = F.xxhash64("doc_id", "text")
    groups = -(-max(words.total, 1) // (_ROUNDS * _GROUP_TOKENS))
    salts = math.isqrt(groups)  # a block's means are taken in two steps, so no task gets the records of all groups
    for turn in range(_ROUNDS):
        sent = texts.sparkSession.sparkContext.broadcast(model)

        def run(batches, sent=sent, turn=turn):
            import copy

            from pyspark import TaskContext

            group = TaskContext.get().partitionId()
            model = copy.deepcopy(sent.value)  # a worker may serve several tasks
            v, rng = model.words.counts.size, np.random.default_rng([turn, group])
            keys, held = [], 0
            for batch in slices(batches, "text", _SLICE):
                found = Texts(batch.column("text"))
                own = model.words.number(found.tokens)
                c1, c2 = found.contexts(own, v + 1)
                keys.append((c2 * (v + 2) + c1) * (v + 1) + own)
                held += own.size
                if held > 2 * _GROUP_TOKENS:
                    model.train(*np.unique(np.concatenate(keys), return_counts=True), rng)
                    keys, held = [], 0
            if held:
                model.train(*np.unique(np.concatenate(keys), return_counts=True), rng)
            yield from model.changed(sent.value, group % salts)

        own = texts.where(F.pmod(deal, F.lit(_ROUNDS)) == turn).select("text", deal.alias("deal"))
        changes = own.repartition(groups, "deal").sortWithinPartitions("deal").select("text").mapInArrow(run, _CHANGES)
        means = _mean_changes(_mean_changes(changes, "block", "salt"), "block")
        model.load(tables.keep(means, f"model{turn}", once=True).toArrow())
        tables.drop(f"model{turn}")
        sent.unpersist()
    return model


_SCORED = (
    "uid bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, in_rest bigint, base double, model double, "
    "rare array<bigint>, times array<int>"
)


def _frequent_parts(docs: DataFrame, model: Model) -> DataFrame:
    """For each text, the sums over its frequent words, and its distinct rare words, left to be looked up.

    ``base`` holds log10(c + 0.1) of frequent words, ``model`` the model's log10 probabilities of frequent words and
    of the shared class.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        from pyspark import TaskContext

        model = sent.value
        words = model.words
        uid = TaskContext.get().partitionId() << 40
        logs = np.log10(np.concatenate(([1.0], words.counts + 0.1)))  # 0 for rare words
        for batch in slices(batches, "text", _SLICE):
            found, rows = Texts(batch.column("text")), batch.num_rows
            own = words.number(found.tokens)
            frequent = own > 0
            c1, c2 = found.contexts(own, words.counts.size + 1)
            base = logs[own]
            prob = model.log_probs(c1, c2, own)
            total = lambda x: np.add.reduceat(x, found.first[:-1])  # noqa: E731  every text has its end
            rare = np.flatnonzero(~frequent)
            order = np.lexsort((found.tokens[rare], found.rows[rare]))
            t, r = found.tokens[rare][order], found.rows[rare][order]
            new = np.flatnonzero(np.concatenate((np.ones(min(t.size, 1), bool), (t[1:] != t[:-1]) | (r[1:] != r[:-1]))))
            times = np.diff(np.concatenate((new, [t.size])))
            cut = np.searchsorted(r[new], np.arange(rows + 1)).astype(np.int32)
            arrays = [
                pa.array(np.arange(uid, uid + rows)), batch.column("doc_id"), batch.column("held_out"), pa.array(np.diff(found.first)),
                pa.array(total(frequent.astype(np.int64))), pa.array(total((~frequent).astype(np.int64))), pa.array(total(base)), pa.array(total(prob)),
                pa.ListArray.from_arrays(pa.array(cut), pa.array(t[new].view(np.int64))),
                pa.ListArray.from_arrays(pa.array(cut), pa.array(times.astype(np.int32))),
            ]
            uid += rows
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in _SCORED.split(", ")])

    return docs.mapInArrow(run, _SCORED)


def scores(docs: DataFrame, held_out: F.Column, classes: int = 256, frequent: int = 1 << 16) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``.

    The model and all counts come from the rows where ``held_out`` is false; a row for which it is null (as of a
    null doc_id) is scored but not learned from. A null text is an empty one: just its end. Repeated rows count and
    are scored each for itself, other columns are not read. With nothing to learn from, scores rest on smoothing.
    """
    tables = Tables(docs.sparkSession, "lm")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out.alias("held_out"), F.col("text").cast("string").alias("text"))
    learned = texts.where("not held_out")
    counts = tables.keep(token_counts(learned), "counts")
    words = vocabulary(counts, classes, frequent)
    model = trained(learned, words, tables)
    scored = tables.keep(_frequent_parts(texts, model), "scored")
    rare = scored.select("uid", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("uid", F.col("w.rare").alias("word"), F.col("w.times").alias("n"))
    c = F.coalesce("c", F.lit(0))
    rare = rare.join(counts, "word", "left").groupBy("uid").agg(
        F.sum(F.col("n") * F.log10(c + 0.1)).alias("rare_logs"), F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("rare_known")
    )
    out = scored.drop("rare", "times").join(rare, "uid", "left")
    logs = F.coalesce("rare_logs", F.lit(0.0))
    floor = float(np.log10(words.total + 0.1 * (words.distinct + 1)))
    rest = float(np.log10(words.rest_total + 0.1 * (words.rest_distinct + 1)))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(words.total).cast("bigint").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * floor).alias("base_score"),
        (F.col("model") + logs - F.col("in_rest") * rest).alias("score"),
    )
