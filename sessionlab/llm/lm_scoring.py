"""Language-model scoring with a hierarchical Pitman-Yor bigram model.

Every word u is a restaurant whose customers are the words that follow it; all restaurants
share one parent restaurant of single words, whose base is uniform over the vocabulary and
one unknown word.  A customer who opens a table sends one customer to the parent.  Seating is
sampled by Gibbs, all customers of a (context, word) group at a time: the number of tables they
fill is drawn from its conditional given the rest (see ``Seating``), so every customer moves in
every sweep, however many there are.  Predictive probabilities are averaged over samples:

    p(w | u) = mean over samples of [c(uw) - d t(uw) + (s + d T(u)) p0(w)] / (s + c(u)).

How it is spread.  Words are 64-bit hashes.  Texts become chunks of about CHUNK_WORDS words
(one row each, in the shared folder).  Chunks send the pairs they hold to shards by context,
so a restaurant lies in one shard; the restaurant of a very frequent word is split over
several by its followers, each taking the tables of the others to be like its own.  Word
counts, the parent's customers and the restaurants' table totals meet in shards by word.
What travels are arrays for (chunk, shard) or (shard, shard), never single rows, and every
quantity is summed before it leaves a task.  During the sweeps of one run the parent stands
as seated before them (the usual approximation of distributed Gibbs); afterwards it is seated
anew for each sample.  A pair seen once has one table, whatever the parent, and is only
counted.

Defined cases: null text is the empty text (one end token); a null doc_id counts as training;
repeated rows count and score one by one; texts of any length are read whole; doc_ids are longs;
words unknown to the training texts are one word;
without training documents every probability is that of the unknown word; an empty table
gives an empty result; clashing extra columns are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlab.llm.chunks import END, MESSAGE, cut, messages, pack, rows_of, text_chunks, unpack, words_of
from sessionlab.llm.common import release, written
from sessionlab.llm.tokens import mix

#: words of training and scored text for each shard (about)
SHARD_WORDS = 2_000_000
#: rows of (word, count) that reach the driver to split frequent contexts: four for each shard at most
MAX_SPLIT_SHARDS = 25_000
#: customers of a group up to which its tables are drawn from the exact conditional
EXACT = 128
#: groups of one size whose tables are drawn at once
BLOCK = 1 << 15


class Settings:
    """Discounts and strengths of the two levels; sweeps before the first sample, samples, and sweeps
    from one to the next."""

    def __init__(self, discount=0.8, strength=1.0, root_discount=0.5, root_strength=10.0, burn_in=6, samples=2, apart=2, seed=42):
        self.discount, self.strength = discount, strength
        self.root_discount, self.root_strength = root_discount, root_strength
        self.burn_in, self.samples, self.apart, self.seed = burn_in, samples, apart, seed


def narrow(h: np.ndarray) -> np.ndarray:
    """48 bits of a word hash in six bytes: what travels for a pair's second word."""
    return np.ascontiguousarray((h >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6])


def wide(b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(b), 8), np.uint8)
    out[:, :6] = b
    return out.view(np.uint64).reshape(-1)


# ------------------------------------------------------------------------------- chunks


class Chunk:
    """Words and pairs of one chunk, the same whenever it is rebuilt."""

    def __init__(self, blob: bytes, held: list[bool], shards: int, split: dict[int, int]):
        self.vocab, self.words, self.sizes = words_of(blob)
        train = ~np.array(held, bool)
        self.train = np.repeat(train, self.sizes)
        ends = np.cumsum(self.sizes.astype(np.int64))
        before = np.empty_like(self.words)
        before[1:] = self.words[:-1]
        before[np.concatenate([[0], ends[:-1]])] = np.searchsorted(self.vocab, END)   # a text starts after an end
        code = before * len(self.vocab) + self.words
        code, self.pair_of = np.unique(code, return_inverse=True)
        self.u, self.w = np.divmod(code, len(self.vocab))
        self.shards, self.split = shards, split

    def word_shards(self) -> np.ndarray:
        return word_shard(self.vocab >> np.uint64(16), self.shards)

    def pairs_by_shard(self) -> tuple[np.ndarray, np.ndarray]:
        """(order of the pairs by shard, shard of each pair in that order)."""
        parts = np.ones(len(self.vocab), np.uint64)
        if self.split:
            hot = np.array(sorted(self.split), np.uint64)
            at = np.minimum(np.searchsorted(hot, self.vocab), len(hot) - 1)
            found = hot[at] == self.vocab
            parts[found] = np.array([self.split[int(h)] for h in hot], np.uint64)[at[found]]
        sub = (self.vocab[self.w] >> np.uint64(20)) % parts[self.u]
        shard = (mix(self.vocab[self.u] + sub * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(self.shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        return order, shard[order]


def word_shard(w48: np.ndarray, shards: int) -> np.ndarray:
    return (w48 % np.uint64(shards)).astype(np.int64)


def _words_of_chunks(shards: int):
    """Vocabulary and training counts of each chunk, for the shards of words; no pairs are built."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, held, blob in zip(*(batch.column(c).to_pylist() for c in ("chunk", "held", "blob"))):
                vocab, words, sizes = words_of(blob)
                train = np.repeat(~np.array(held, bool), sizes)
                counts = np.bincount(words, weights=train, minlength=len(vocab)).astype(np.uint32)
                shard = word_shard(vocab >> np.uint64(16), shards)
                order = np.argsort(shard, kind="stable")
                yield from messages([("chunk", s, number, pack(vocab[order[k]], counts[order[k]])) for s, k in cut(shard[order])]).to_batches()
    return run


def _each_chunk(shards: int, split: dict[int, int], send: Callable[[int, Chunk], list]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, held, blob in zip(*(batch.column(c).to_pylist() for c in ("chunk", "held", "blob"))):
                yield from messages(send(number, Chunk(blob, held, shards, split))).to_batches()
    return run


def _send_pairs(number: int, c: Chunk) -> list:
    order, shard = c.pairs_by_shard()
    counts = np.bincount(c.pair_of, weights=c.train, minlength=len(c.u)).astype(np.uint32)
    out = []
    for s, k in cut(shard):
        at = order[k]
        u, n = np.unique(c.u[at], return_counts=True)     # pairs are in order of u within a shard
        out.append(("pairs", s, number, pack(c.vocab[u], n.astype(np.uint32), narrow(c.vocab[c.w[at]]), counts[at])))
    return out


# ------------------------------------------------------------------------ restaurants


def _words_total(threshold: float):
    """A shard of words: what stays of the chunks' lists, number of training words, frequent words."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        lists = [(p, *unpack(b)) for p, b in rows_of(table, "chunk")]
        words, at = np.unique(np.concatenate([x[1] for x in lists]), return_inverse=True)
        count = np.bincount(at, weights=np.concatenate([x[2] for x in lists]), minlength=len(words)).astype(np.int64)
        frequent = count > threshold
        return messages([("total", key[0].as_py(), 0, pack(int((count > 0).sum()), int(count.sum()), words[frequent], count[frequent]))])
    return run


def _build(shards: int):
    """A shard of restaurants from the pairs of all chunks."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        me = key[0].as_py()
        asked = [(p, *unpack(b)) for p, b in rows_of(table, "pairs")]
        us = np.concatenate([np.repeat(u, n) for _, u, n, _, _ in asked])
        ws = np.concatenate([wide(w) for *_, w, _ in asked])
        cs = np.concatenate([c for *_, c in asked])
        context, u = np.unique(us, return_inverse=True)
        word, w = np.unique(ws, return_inverse=True)
        code, pair = np.unique(u * len(word) + w, return_inverse=True)
        count = np.bincount(pair, weights=cs, minlength=len(code)).astype(np.int64)
        pu, pw = np.divmod(code, len(word))
        many, once = count > 1, count == 1
        single_u, single_w = np.bincount(pu[once], minlength=len(context)), np.bincount(pw[once], minlength=len(word))
        many_w = np.bincount(pw[many], minlength=len(word))
        used, many_word = np.unique(pw[many], return_inverse=True)
        out = [("state", me, 0, pack(context, single_u.astype(np.uint32), pu[many].astype(np.uint32), count[many].astype(np.uint32),
                                     word[used], many_word.astype(np.uint32)))]
        # what each chunk asked for: 0 unseen, 1 once, 2 the next of the list of repeated pairs
        number = np.cumsum(many) - 1
        kind = np.minimum(count, 2).astype(np.uint8)
        at = 0
        for p, _, _, x, _ in asked:
            own = pair[at:at + len(x)]
            at += len(x)
            out.append(("asked", me, p, pack(kind[own], number[own[kind[own] == 2]].astype(np.uint32))))
        trained = (single_w + many_w) > 0
        own, one, more = word[trained], single_w[trained].astype(np.uint32), many_w[trained].astype(np.uint32)
        dest = word_shard(own, shards)
        order = np.argsort(dest, kind="stable")
        out += [("first", s, me, pack(narrow48(own[order[k]]), one[order[k]], more[order[k]])) for s, k in cut(dest[order])]
        return messages(out)
    return run


def narrow48(w48: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(w48.view(np.uint8).reshape(-1, 8)[:, :6])


_STIRLING: dict[float, list[np.ndarray]] = {}


def log_stirling(discount: float) -> list[np.ndarray]:
    """By number of customers c <= EXACT: log of the generalised Stirling numbers of 1 .. c tables,
    the weight of all seatings of c customers at so many tables."""
    if discount not in _STIRLING:
        rows = [np.empty(0), np.zeros(1)]
        for c in range(1, EXACT):
            new = np.full(c + 1, -np.inf)
            new[:c] = np.log(c - discount * np.arange(1, c + 1)) + rows[c]
            new[1:] = np.logaddexp(new[1:], rows[c])
            rows.append(new)
        _STIRLING[discount] = rows
    return _STIRLING[discount]


def many_tables(count: np.ndarray, new: np.ndarray, discount: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean and variance of the number of tables of large groups, from the saddle point of their
    generating function exp(new (1 - (1 - x)^discount) / discount); within 2 % of the sums
    over Stirling numbers beyond EXACT customers."""
    lo, hi = np.full(len(count), -700.0), np.zeros(len(count))       # log(1 - x)
    for _ in range(50):
        y = (lo + hi) / 2
        over = np.log(new) + np.log1p(-np.exp(y)) + (discount - 1) * y > np.log(count)
        lo, hi = np.where(over, y, lo), np.where(over, hi, y)
    y = np.exp((lo + hi) / 2)
    mean = new * -np.expm1(discount * np.log(y)) / discount
    variance = np.maximum(mean - count * y / (1 - discount * (1 - y)), 0.0)
    return mean + variance / np.maximum(mean, 1e-300), variance


class Seating:
    """Numbers of tables of (restaurant, dish) groups with two customers or more.

    Predictions need no more of a seating than its numbers of tables, so a sweep draws for each
    group how many tables its customers fill, given all others: with probability proportional
    to the weight of all seatings at t tables (generalised Stirling numbers) times that of t
    new tables.  All customers of a group move at once.  Up to EXACT customers the draw is from
    the exact conditional, beyond from a law with its mean and variance.  The tables of a
    restaurant are ``fixed`` (dishes with one customer) plus those here, times ``scale`` where
    other shards hold the rest of it.
    """

    def __init__(self, rest: np.ndarray, count: np.ndarray, p0: np.ndarray, fixed: np.ndarray, scale: np.ndarray,
                 discount: float, strength: float, rng: np.random.Generator):
        self.rest, self.count, self.p0, self.d, self.s, self.rng = rest, count.astype(np.int64), p0, discount, strength, rng
        self.fixed, self.scale = fixed.astype(np.int64), scale
        self.tables = np.ones(len(count), np.int64)
        self.order = np.argsort(self.count, kind="stable")
        self._recount()

    def _recount(self) -> None:
        self.total = self.fixed + np.bincount(self.rest, weights=self.tables, minlength=len(self.fixed)).astype(np.int64)

    def sweep(self, rounds: int = 1) -> None:
        """Draw the tables of every group anew, one half of the groups after the other."""
        for _ in range(rounds):
            half = self.rng.random(len(self.count)) < 0.5
            for now in (half, ~half):
                at = self.order[now[self.order]]
                r = self.rest[at]
                # weight of a first table of the group, all other groups as they are
                first = (self.s + self.d * (self.total[r] * self.scale[r] - self.tables[at])) * self.p0[at]
                self.tables[at] = self._draw(self.count[at], np.maximum(first, 1e-300), self.d * self.p0[at])
                self._recount()

    def _draw(self, count: np.ndarray, first: np.ndarray, step: np.ndarray) -> np.ndarray:
        """Tables of groups in order of count; a group's table after j of its own weighs first + j step."""
        out = np.ones(len(count), np.int64)
        small = int(np.searchsorted(count, EXACT, side="right"))
        rows = log_stirling(self.d)
        for c, k in cut(count[:small]):
            for at in range(k.start, k.stop, BLOCK):
                own = slice(at, min(at + BLOCK, k.stop))
                weight = np.cumsum(np.log(first[own, None] + step[own, None] * np.arange(c)), axis=1) + rows[c]
                running = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
                pick = self.rng.random(len(running)) * running[:, -1]
                out[own] = 1 + np.minimum((running <= pick[:, None]).sum(axis=1), c - 1)
        if small < len(count):
            # tables of the group make further ones likelier: the weight at the mean counts, and
            # what it gains by each table widens the law
            n, weigh, gain = count[small:], first[small:], step[small:]
            mean, variance = many_tables(n, weigh, self.d)
            for _ in range(6):
                mean, variance = many_tables(n, weigh + gain * mean, self.d)
            slope = gain / (weigh + gain * mean)
            variance = variance / np.maximum(1 - variance * slope, 0.1)
            out[small:] = 1 + np.minimum(_with_moments(mean - 1, variance, self.rng), n - 1)
        return out


def _with_moments(mean: np.ndarray, variance: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Counts of given mean and variance: binomial below the mean, negative binomial above."""
    mean = np.maximum(mean, 1e-9)
    tries = np.maximum(np.rint(mean * mean / np.maximum(mean - variance, 1e-6 * mean)), 1.0)
    shape = mean * mean / np.maximum(variance - mean, 1e-6 * mean)
    few = rng.binomial(tries.astype(np.int64), np.minimum(mean / tries, 1.0))
    return np.where(variance <= mean, few, rng.negative_binomial(shape, shape / (shape + mean)))


def _generator(settings: Settings, *key: int) -> np.random.Generator:
    return np.random.default_rng([settings.seed, *key])


def _seat_root(customers: np.ndarray, vocabulary: int, settings: Settings, rng) -> np.ndarray:
    """Tables of each word in the parent restaurant (this shard's words; the total, which other
    shards share, is estimated from the words at hand)."""
    tables = (customers > 0).astype(np.int64)
    many = np.flatnonzero(customers > 1)
    share = max(1.0, vocabulary / max(1, int(tables.sum())))
    seating = Seating(np.zeros(len(many), np.int64), customers[many], np.full(len(many), 1.0 / (vocabulary + 1)),
                      np.array([int((customers == 1).sum())]), np.array([share]), settings.root_discount, settings.root_strength, rng)
    seating.sweep(settings.burn_in)
    tables[many] = seating.tables
    return tables


def _root_first(vocabulary: int, settings: Settings):
    """A shard of the parent's words: seat one customer for each pair, answer the shards of pairs
    with c - d t of the words they repeat."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        me = key[0].as_py()
        got = [(p, *unpack(b)) for p, b in rows_of(table, "first")]
        word, at = np.unique(np.concatenate([wide(x[1]) for x in got]), return_inverse=True)
        customers = np.bincount(at, weights=np.concatenate([x[2].astype(np.int64) + x[3] for x in got]), minlength=len(word)).astype(np.int64)
        tables = _seat_root(customers, vocabulary, settings, _generator(settings, 1, me))
        mass = (customers - settings.root_discount * tables).astype(np.float32)
        out, i = [("sum", me, 0, pack(int(customers.sum()), int(tables.sum())))], 0
        for p, w, _, more in got:
            own = at[i:i + len(w)]
            i += len(w)
            out.append(("root", p, me, pack(narrow48(word[own[more > 0]]), mass[own[more > 0]])))
        return messages(out)
    return run


def _root_rest(sums: tuple[int, int], vocabulary: int, settings: Settings) -> tuple[float, float]:
    """(mass that every word has besides its own, all mass) of the parent."""
    customers, tables = sums
    return ((settings.root_strength + settings.root_discount * tables) / (vocabulary + 1), settings.root_strength + customers)


def _gibbs(shards: int, split: dict[int, int], rest: tuple[float, float], settings: Settings):
    """Seat and sweep one shard's restaurants; answer the chunks, and send the tables to the words."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        me = key[0].as_py()
        context, fixed, u, count, word, w = unpack(rows_of(table, "state")[0][1])
        p0 = np.zeros(len(word))
        for _, blob in rows_of(table, "root"):
            own, mass = unpack(blob)
            p0[np.searchsorted(word, wide(own))] = mass
        p0 = (p0 + rest[0]) / rest[1]
        scale = np.array([split.get(int(h), 1) for h in context], float) if split else np.ones(len(context))
        seating = Seating(u.astype(np.int64), count, p0[w], fixed, scale, settings.discount, settings.strength,
                          _generator(settings, 2, me))
        seating.sweep(settings.burn_in)
        mean, by_word, by_context = np.zeros(len(count)), [], []
        for _ in range(settings.samples):
            seating.sweep(settings.apart)
            mean += seating.tables / settings.samples
            by_word.append(np.bincount(w, weights=seating.tables, minlength=len(word)).astype(np.uint32))
            by_context.append(seating.total.astype(np.uint32))
        left = (count - settings.discount * mean).astype(np.float32)
        out = [("answer", p, me, pack(kind, left[which])) for p, kind, which in
               ((p, *unpack(b)) for p, b in rows_of(table, "asked"))]
        for name, own, sums in (("tables", word, by_word), ("totals", context >> np.uint64(16), by_context)):
            dest = word_shard(own, shards)
            order = np.argsort(dest, kind="stable")
            sums = np.array(sums)
            out += [(name, s, me, pack(narrow48(own[order[k]]), sums[:, order[k]])) for s, k in cut(dest[order])]
        return messages(out)
    return run


def _root_last(vocabulary: int, settings: Settings):
    """A shard of words: seat the parent for each sample and answer the chunks with, for each of
    their words, training count, parent mass and table total by sample."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        me = key[0].as_py()
        lists = [(p, *unpack(b)) for p, b in rows_of(table, "chunk")]
        if not lists:
            return messages([])
        word, at = np.unique(np.concatenate([x[1] for x in lists]), return_inverse=True)
        count = np.bincount(at, weights=np.concatenate([x[2] for x in lists]), minlength=len(word)).astype(np.int64)
        short = word >> np.uint64(16)
        once = np.zeros(len(word), np.int64)
        for _, blob in rows_of(table, "first"):
            own, one, _ = unpack(blob)
            np.add.at(once, np.searchsorted(short, wide(own)), one)
        sums = {"tables": np.tile(once, (settings.samples, 1)), "totals": np.zeros((settings.samples, len(word)), np.int64)}
        for name, total in sums.items():
            for _, blob in rows_of(table, name):
                own, values = unpack(blob)
                np.add.at(total, (slice(None), np.searchsorted(short, wide(own))), values)
        mass, out = np.zeros((settings.samples, len(word)), np.float32), []
        for k in range(settings.samples):
            customers = sums["tables"][k]
            tables = _seat_root(customers, vocabulary, settings, _generator(settings, 3, me, k))
            mass[k] = customers - settings.root_discount * tables
            out.append(("sum", me, k, pack(int(customers.sum()), int(tables.sum()))))
        totals, i = sums["totals"].astype(np.uint32), 0
        for p, w, _ in lists:
            own = at[i:i + len(w)]
            i += len(w)
            out.append(("words", p, me, pack(count[own], mass[:, own], totals[:, own])))
        return messages(out)
    return run


def _score(shards: int, split: dict[int, int], n_train: int, vocabulary: int, rests: list[tuple[float, float]], settings: Settings):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        t = table.filter(pc.equal(table.column("kind"), "text"))
        ids, held = t.column("ids").to_pylist()[0], t.column("held").to_pylist()[0]
        c = Chunk(t.column("blob").to_pylist()[0], held, shards, split)
        n = len(c.vocab)
        count, mass, totals = np.zeros(n, np.int64), np.zeros((settings.samples, n)), np.zeros((settings.samples, n))
        shard = c.word_shards()
        order = np.argsort(shard, kind="stable")
        where = dict(cut(shard[order]))
        for s, blob in rows_of(table, "words"):
            at = order[where[s]]
            count[at], mass[:, at], totals[:, at] = unpack(blob)
        order, shard = c.pairs_by_shard()
        where = dict(cut(shard))
        left = np.zeros(len(c.u))
        for s, blob in rows_of(table, "answer"):
            kind, many = unpack(blob)
            own = np.array([0.0, 1 - settings.discount, 0.0])[kind]
            own[kind == 2] = many
            left[order[where[s]]] = own
        p0 = np.array([(m + a) / b for m, (a, b) in zip(mass, rests)])
        back = np.mean([(settings.strength + settings.discount * totals[k][c.u]) * p0[k][c.w] for k in range(settings.samples)], axis=0)
        seen = count[c.u]
        p = np.where(seen > 0, (left + back) / (settings.strength + seen), p0.mean(axis=0)[c.w])
        base = np.log10((count + 0.5) / (n_train + 0.5 * (vocabulary + 1)))
        first = np.cumsum(c.sizes.astype(np.int64)) - c.sizes
        known = np.add.reduceat((count > 0).astype(np.int64)[c.words], first)
        size = c.sizes.astype(np.int64)
        score = np.add.reduceat(np.log10(p)[c.pair_of], first)
        return pa.table({"id": pa.array(ids, pa.int64()), "held_out": held, "n_tokens": size, "n_known": known,
                         "train_tokens": np.full(len(size), n_train), "base_score": np.add.reduceat(base[c.words], first),
                         "score": score, "perplexity": 10 ** np.minimum(-score / size, 300.0)})
    return run


def _grouped(df: DataFrame, run) -> DataFrame:
    return df.groupBy("key").applyInArrow(run, MESSAGE)


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", held_out: Column | None = None,
                    settings: Settings | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity of every row.

    The model learns from the rows that ``held_out`` does not mark (null: not marked).
    """
    settings, spark = settings or Settings(), docs.sparkSession
    chunks = text_chunks(docs, doc_id, text, held_out)
    words = chunks.agg(F.sum("n")).first()[0] or 0
    shards = max(4, math.ceil(words / SHARD_WORDS))
    lists = chunks.mapInArrow(_words_of_chunks(shards), MESSAGE)     # read again when needed, not kept
    threshold = words / (4 * min(shards, MAX_SPLIT_SHARDS))
    found = [unpack(r["blob"]) for r in _grouped(lists, _words_total(threshold)).collect()]   # a row for each shard
    vocabulary = sum(x[0] for x in found)
    n_train = sum(x[1] for x in found)
    split = {int(h): 1 + int(c / threshold) for *_, hs, cs in found for h, c in zip(hs, cs)}
    pairs = written(_grouped(chunks.mapInArrow(_each_chunk(shards, split, _send_pairs), MESSAGE), _build(shards)), "lm-pairs", by="kind")
    release(spark)
    first = written(_grouped(pairs.filter("kind = 'first'"), _root_first(vocabulary, settings)), "lm-root")

    def sums(df: DataFrame) -> list[tuple[int, int]]:
        got = [(r["peer"], *unpack(r["blob"])) for r in df.filter("kind = 'sum'").select("peer", "blob").collect()]
        return [(sum(c for k, c, _ in got if k == s), sum(t for k, _, t in got if k == s)) for s in range(settings.samples)]
    release(spark)
    rest = _root_rest(sums(first)[0], vocabulary, settings)
    seated = written(_grouped(pairs.filter("kind IN ('state', 'asked')").unionByName(first.filter("kind = 'root'")),
                              _gibbs(shards, split, rest, settings)), "lm-seated")
    release(spark, pairs, parts=("kind=state", "kind=asked"))
    last = written(_grouped(lists.unionByName(pairs.filter("kind = 'first'"))
                            .unionByName(seated.filter("kind IN ('tables', 'totals')")), _root_last(vocabulary, settings)), "lm-last")
    rests = [_root_rest(s, vocabulary, settings) for s in sums(last)]
    release(spark, pairs, first)
    texts = chunks.select(F.lit("text").alias("kind"), F.col("chunk").alias("key"), F.lit(0).cast("long").alias("peer"), "blob", "ids", "held")
    answers = seated.filter("kind = 'answer'").unionByName(last.filter("kind = 'words'"))
    schema = ("id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
              "perplexity double")
    return (texts.unionByName(answers, allowMissingColumns=True).groupBy("key")
            .applyInArrow(_score(shards, split, n_train, vocabulary, rests, settings), schema).withColumnRenamed("id", doc_id))
