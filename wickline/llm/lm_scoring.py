"""LM scoring (operator 8) with a weighted backoff automaton.

The model interpolates absolute discounting over word n-grams up to order 3.
Its states are the root, words and word pairs that begin a kept n-gram; an arc
carries the discounted probability of the next word, and a failure arc to the
next shorter context carries the weight that is left, so probabilities of a
state sum to one.  A traversal of a text keeps the state of its last words and
adds the log10 probability of each token; ``</end>`` closes a text and is the
context of the next one's first word.

All counts are exact over the whole corpus, and every n-gram that occurs
``LEAST`` times is kept, whatever the corpus' size.  Nothing of the model is
sent to all tasks: a block of texts deals its distinct words, pairs and triples
out by hash range, each range adds up its own, and a block gets back the totals
of what it holds.  Triples are dealt out only where both their pairs are kept,
as no other can be.  The weight of a context's arcs is added up the same way:
the one block that a kept n-gram belongs to adds it to the context's sum.

Defined cases: a null or empty text is its end token alone; a null id is never
held out; rows are independent, so repeated ids stay as they are and each row
of a training id is learnt from; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.llm.base import arrow_iter, batch, staged
from wickline.llm.text import MIX_B, U64, chunks, mix, word_hashes

#: Occurrences from which on an n-gram is kept.
LEAST = 2
#: A relative frequency that n-grams must reach besides, for smaller models.
SHARE = 0.0
DISCOUNT = 0.75
#: Bytes of text of a block: the unit in which words are counted and joined.
BLOCK_BYTES = 8 << 20
#: Ranges of hashes: at least so many, and one for so many bytes of text.
RANGES, RANGE_BYTES = 64, 16 << 20
END = U64(0x5E0D0FD0C5E0D0FD)
#: Stands before the end that opens a text, so that pair is no counted one.
BEFORE = U64(0xBEF0BEF0BEF0BEF1)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that the model does not learn from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 7 == 2, F.lit(False))


@dataclass
class Tokens:
    """The tokens of a run of texts, one after another, each with its end."""

    word: np.ndarray
    start: np.ndarray  # of each text; the last entry is the total
    first: np.ndarray = field(init=False)

    def __post_init__(self):
        self.first = np.zeros(len(self.word), bool)
        self.first[self.start[:-1]] = True

    def contexts(self) -> tuple[np.ndarray, np.ndarray]:
        """The last word and the hash of the last two before each token."""
        one = np.empty_like(self.word)
        one[1:], one[:1] = self.word[:-1], END
        one[self.first] = END
        two = np.empty_like(one)
        two[1:], two[:1] = one[:-1], BEFORE
        two[self.first] = BEFORE
        return one, join(two, one)


def join(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a longer n-gram."""
    return mix(context * MIX_B + word)


def _tokens(texts: pa.Array) -> Iterator[tuple[int, int, Tokens]]:
    for r0, r1, data, off in chunks(texts):
        h, before = word_hashes(data, off)
        word = np.insert(h, before[1:], END)
        yield r0, r1, Tokens(word, before + np.arange(len(before)))


def _merge(tokens: list[Tokens]) -> Tokens:
    if not tokens:
        return Tokens(np.zeros(0, np.uint64), np.zeros(1, np.int64))
    sizes = np.cumsum([0, *(len(t.word) for t in tokens)])
    starts = [t.start[:-1] + s for t, s in zip(tokens, sizes, strict=False)]
    return Tokens(np.concatenate([t.word for t in tokens]), np.concatenate([*starts, sizes[-1:]]))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Runs of rows of about ``BLOCK_BYTES`` of text with the block's number.
    The same partition always gives the same blocks."""
    number, held, size = TaskContext.get().partitionId() << 20, [], 0
    for b in batches:
        at = 0
        text = b["text"]
        sizes = np.cumsum(np.diff(np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)))
        while at < b.num_rows:
            base = sizes[at - 1] if at else 0
            end = min(int(np.searchsorted(sizes, base + BLOCK_BYTES - size, side="left")) + 1, b.num_rows)
            held.append(b.slice(at, end - at))
            size += int(sizes[end - 1] - base)
            at = end
            if size >= BLOCK_BYTES:
                yield number, held
                number, held, size = number + 1, [], 0
    if held:
        yield number, held


def _distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted values, a place of each, the value's number at each place)."""
    order = np.argsort(h)
    ordered = h[order]
    new = np.ones(len(h), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    of = np.empty(len(h), np.int64)
    of[order] = np.cumsum(new) - 1
    return ordered[new], order[new], of


def _member(sorted_values: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(found, place) of each hash in a sorted array."""
    if not len(sorted_values):
        return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
    at = np.minimum(np.searchsorted(sorted_values, h), len(sorted_values) - 1)
    return sorted_values[at] == h, at


def _values(keys: np.ndarray, values: np.ndarray, h: np.ndarray, default: float) -> np.ndarray:
    """The value of each hash, or the default, which also stands at the end."""
    out = np.full(len(h) + 1, default)
    found, at = _member(keys, h)
    out[:-1][found] = values[at[found]]
    return out


@dataclass
class NGrams:
    """Kept n-grams of an order, sorted by hash, with contexts and counts.
    ``at``, if given: the place of each context among the n-grams of the order
    below, all of which are there."""

    gram: np.ndarray
    context: np.ndarray
    count: np.ndarray
    at: np.ndarray | None = None


@dataclass
class Numbered:
    """What a run of tokens looks up at an order: its contexts and n-grams,
    each once and sorted, and their numbers at each token (-1: none of them)."""

    context: np.ndarray
    context_of: np.ndarray
    gram: np.ndarray
    gram_of: np.ndarray


def _numbered(tokens: Tokens) -> list[Numbered]:
    out = []
    for context in tokens.contexts():
        (c, _, c_of), (g, _, g_of) = _distinct(context), _distinct(join(context, tokens.word))
        out.append(Numbered(c, c_of, g, g_of))
    return out


@dataclass
class Automaton:
    """States by context hash with their failure weights, arcs by n-gram hash."""

    tokens: int
    types: int
    states: dict[int, tuple[np.ndarray, np.ndarray]]
    arcs: dict[int, tuple[np.ndarray, np.ndarray]]

    def root(self, count: np.ndarray) -> np.ndarray:
        """Add-one probabilities of words by their training counts."""
        return (count + 1.0) / (self.tokens + self.types + 1.0)

    def traverse(self, tokens: Tokens, count: np.ndarray, numbered: list[Numbered] | None = None) -> np.ndarray:
        """log10 probability of every token.  The state before a token is its
        longest context that is a state; without an arc there, the failure
        arcs lead down to the root.  States and arcs are looked up once for
        all tokens that share them."""
        p = self.root(count)
        for order, n in zip((2, 3), numbered or _numbered(tokens), strict=True):
            p *= _values(*self.states[order], n.context, 1.0)[n.context_of]
            p += _values(*self.arcs[order], n.gram, 0.0)[n.gram_of]  # every arc starts at a state
        return np.log10(p)


Sums = dict[int, tuple[np.ndarray, np.ndarray]]


def _automaton(tokens: int, types: int, words: np.ndarray, counts: np.ndarray, grams: dict[int, NGrams], sums: Sums | None = None) -> Automaton:
    """States, arcs and weights; ``words`` are sorted.  ``grams`` may be a part
    of the model if ``sums`` has the discounted counts of all arcs by context."""
    states, arcs = {}, {}
    known, totals = words, counts
    for order in (2, 3):
        g = grams[order]
        gram, context, n, at = g.gram, g.context, g.count, g.at
        if at is None:
            there, at = _member(known, context)  # the start of a text has no count of its own
            gram, context, n, at = gram[there], context[there], n[there], at[there]
        arcs[order] = gram, (n - DISCOUNT) / totals[at]
        if sums is None:
            state, of = np.unique(context, return_inverse=True)
            mass = np.bincount(of, weights=n - DISCOUNT, minlength=len(state))
        else:
            some = sums[order][1] > 0
            state, mass = sums[order][0][some], sums[order][1][some]
        _, at = _member(known, state)
        states[order] = state, np.maximum(1.0 - mass / totals[at], 1e-9)
        known, totals = g.gram, g.count
    return Automaton(tokens, types, states, arcs)


#: What is dealt out: counts of words, pairs and triples, and the discounted
#: counts of all arcs of a word and of a pair.
WORD, PAIR, TRIPLE, OF_WORD, OF_PAIR = range(5)
_DEALT = "block long, kind int, part int, check long, keys binary, amounts binary"
_TOTALS = "block long, kind int, part int, check long, n int, totals binary, own binary, occurrences double, types long"
#: Spark deletes a query's shuffle files when it ends, which nothing reads any more.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ZSTD = pa.Codec("zstd", 1)


def _small(spans: list[np.ndarray]) -> pa.Array:
    return pa.array([_ZSTD.compress(np.ascontiguousarray(x), asbytes=True) for x in spans], pa.binary())


def _large(column: pa.ChunkedArray, sizes: list[int], kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    spans = [np.frombuffer(_ZSTD.decompress(x.as_py(), n * width), kind) for x, n in zip(column, sizes, strict=True)]
    return np.concatenate([np.zeros(0, kind), *spans])


def _deal(block: int, kind: int, keys: np.ndarray, amounts: np.ndarray, ranges: int) -> pa.RecordBatch:
    """A row for each range of hashes that holds some of the sorted ``keys``."""
    bounds = np.arange(1, ranges, dtype=np.uint64) << U64(65 - ranges.bit_length())
    cut = np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]])
    some = np.flatnonzero(np.diff(cut))
    spans = [(cut[i], cut[i + 1]) for i in some]
    n = len(some)
    return batch(
        block=np.full(n, block, np.int64), kind=np.full(n, kind, np.int32), part=some.astype(np.int32),
        check=np.array([keys[a:z].sum() for a, z in spans], np.uint64).view(np.int64),
        keys=pa.array([keys[a:z].tobytes() for a, z in spans], pa.binary()),
        amounts=_small([amounts[a:z].astype(np.float64) for a, z in spans]),
    )


def _add(table: pa.Table) -> pa.Table:
    """The totals of a range, told to each block in the order of its keys;
    ``own`` marks one block of each key."""
    keys = [np.frombuffer(x.as_py(), np.uint64) for x in table["keys"]]
    sizes = [len(k) for k in keys]
    amounts, ends = _large(table["amounts"], sizes, np.float64), np.cumsum(sizes)[:-1]
    _, at, of = _distinct(np.concatenate(keys))
    total = np.bincount(of, weights=amounts)[of]
    own = np.zeros(len(total), np.uint8)
    own[at] = 1
    totals, owns = np.split(total, ends), np.split(own, ends)
    return pa.table({
        **{c: table[c] for c in ("block", "kind", "part", "check")},
        "n": pa.array(sizes, pa.int32()),
        "totals": _small(totals),
        "own": _small(owns),
        "occurrences": pa.array([float(t[o > 0].sum()) for t, o in zip(totals, owns, strict=True)]),
        "types": pa.array([int((t[o > 0] > 0).sum()) for t, o in zip(totals, owns, strict=True)]),
    })


def _added(dealt: DataFrame) -> DataFrame:
    conf = dealt.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return staged(dealt.groupBy("kind", "part").applyInArrow(_add, _TOTALS), "lm-totals")
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)


class _Block:
    """The tokens of a block and, as far as their totals are there, its words
    (sorted), pairs and triples with what is learnt of them."""

    def __init__(self, rows: list[pa.RecordBatch], totals: pa.Table | None = None, least: int = LEAST):
        self._totals, self.least = totals, least
        tokens, learn = [], []
        for b in rows:
            for r0, r1, t in _tokens(b["text"]):
                own = pc.fill_null(b["learn"].slice(r0, r1 - r0), False).to_numpy(zero_copy_only=False)
                tokens.append(t)
                learn.append(np.repeat(own, np.diff(t.start)))
        self.tokens, self.learn = _merge(tokens), np.concatenate([np.zeros(0, bool), *learn])
        self.one, self.two = self.tokens.contexts()

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        self.word, _, self.word_of = _distinct(self.tokens.word)
        self.one_of = np.empty_like(self.word_of)  # every word is the context of what follows it
        self.one_of[1:] = self.word_of[:-1]
        self.one_of[self.tokens.first] = np.searchsorted(self.word, END)
        return self.word, np.bincount(self.word_of, weights=self.learn, minlength=len(self.word))

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        self.pair, self.pair_at, self.pair_of = _distinct(join(self.one, self.tokens.word))
        return self.pair, np.bincount(self.pair_of, weights=self.learn, minlength=len(self.pair))

    def triples(self) -> tuple[np.ndarray, np.ndarray]:
        """Those whose pairs are both kept."""
        self.pair_total, self.pair_own = self.total(PAIR, self.pair)
        kept = (self.pair_total >= self.least)[self.pair_of]
        self.lead = np.zeros_like(kept)
        self.lead[1:] = kept[:-1]
        self.lead[self.tokens.first] = False
        maybe = np.flatnonzero(kept & self.lead)
        self.triple, at, of = _distinct(join(self.two[maybe], self.tokens.word[maybe]))
        self.triple_at = maybe[at]
        self.triple_of = np.full(len(kept), -1)
        self.triple_of[maybe] = of
        return self.triple, np.bincount(of, weights=self.learn[maybe], minlength=len(self.triple))

    def _arcs(self, contexts: int, of: np.ndarray, total: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The discounted counts of the arcs that belong to this block, by the
        number of their context."""
        arc = (total >= self.least) & own
        return np.bincount(of[arc], weights=total[arc] - DISCOUNT, minlength=contexts)

    def of_words(self) -> tuple[np.ndarray, np.ndarray]:
        return self.word, self._arcs(len(self.word), self.one_of[self.pair_at], self.pair_total, self.pair_own)

    def of_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        self.triple_total, self.triple_own = self.total(TRIPLE, self.triple)
        leads = np.zeros(len(self.pair), bool)
        leads[self.pair_of[np.flatnonzero(self.lead) - 1]] = True
        number = np.cumsum(leads) - 1
        return self.pair[leads], self._arcs(int(leads.sum()), number[self.pair_of[self.triple_at - 1]], self.triple_total, self.triple_own)

    def total(self, kind: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(total, belongs to this block) of each key."""
        t = self._totals.filter(pc.equal(self._totals["kind"], kind)).sort_by("part")
        sizes = t["n"].to_pylist()
        total, own = _large(t["totals"], sizes, np.float64), _large(t["own"], sizes, np.uint8) > 0
        check = t["check"].to_numpy().view(np.uint64).sum(dtype=np.uint64)
        if len(total) != len(keys) or check != keys.sum(dtype=np.uint64):
            raise RuntimeError("a partition changed between scans of the texts")
        return total, own

    def numbered(self) -> list[Numbered]:
        """The block's contexts and n-grams, as counted."""
        before = np.full(len(self.pair_of), -1)  # no pair stands before a text
        before[1:] = self.pair_of[:-1]
        before[self.tokens.first] = -1
        return [Numbered(self.word, self.one_of, self.pair, self.pair_of), Numbered(self.pair, before, self.triple, self.triple_of)]

    def model(self, tokens: int, types: int) -> tuple[Automaton, np.ndarray]:
        """The part of the automaton that the block's texts can reach, and the
        training count of each token."""
        self.words()
        self.pairs()
        self.triples()
        of_word, of_pair = self.of_words()[0], self.of_pairs()[0]
        count, _ = self.total(WORD, self.word)
        two, three = self.pair_total >= self.least, self.triple_total >= self.least
        start, lead = self.pair_at[two], self.triple_at[three]
        below = (np.cumsum(two) - 1)[self.pair_of[lead - 1]]
        grams = {
            2: NGrams(self.pair[two], self.one[start], self.pair_total[two], self.one_of[start]),
            3: NGrams(self.triple[three], self.two[lead], self.triple_total[three], below),
        }
        sums = {2: (of_word, self.total(OF_WORD, of_word)[0]), 3: (of_pair, self.total(OF_PAIR, of_pair)[0])}
        return _automaton(tokens, types, self.word, count, grams, sums), count[self.word_of]


def _packed(src: DataFrame) -> DataFrame:
    """(block, rows): the texts of each block."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for block, rows in _blocks(batches):
            for b in rows:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, b.schema, options=options) as out:
                    out.write_batch(b)
                yield batch(block=np.array([block]), rows=pa.array([sink.getvalue().to_pybytes()], pa.binary()))

    return arrow_iter(src, pack, "block long, rows binary")


def _unpacked(packed: pa.Table) -> list[pa.RecordBatch]:
    return [b for raw in packed["rows"] for b in pa.ipc.open_stream(raw.as_py())]


def _with_totals(src: DataFrame, totals: list[DataFrame], fn, schema: str) -> DataFrame:
    """``fn`` of each block's texts and totals."""
    every = reduce(DataFrame.unionAll, totals).select("block", "kind", "part", "check", "n", "totals", "own")
    return _packed(src).groupBy("block").cogroup(every.groupBy("block")).applyInArrow(fn, schema)


def lm_scores(df: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every
    text, learning from rows for which ``learn`` holds.  ``df`` is scanned
    several times and must give the same partitions each time, as a table's
    files do; a partition that changed is found out and fails the job."""
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), learn.alias("learn"), F.col(text_col).alias("text"))
    size = src.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    ranges = max(RANGES, 1 << (size // RANGE_BYTES).bit_length())

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in _blocks(batches):
            block = _Block(rows)
            yield _deal(number, WORD, *block.words(), ranges)
            yield _deal(number, PAIR, *block.pairs(), ranges)

    first = _added(arrow_iter(src, counts, _DEALT))
    tokens, types = first.where(F.col("kind") == WORD).agg(F.sum("occurrences"), F.sum("types")).first()
    tokens, types = int(tokens or 0), int(types or 0)
    least = max(LEAST, int(np.ceil(SHARE * tokens)))

    def triples(packed: pa.Table, totals: pa.Table) -> pa.Table:
        block, number = _Block(_unpacked(packed), totals, least), packed["block"][0].as_py()
        block.words()
        block.pairs()
        dealt = _deal(number, TRIPLE, *block.triples(), ranges)
        return pa.Table.from_batches([dealt, _deal(number, OF_WORD, *block.of_words(), ranges)])

    def arcs_of_pairs(packed: pa.Table, totals: pa.Table) -> pa.Table:
        block, number = _Block(_unpacked(packed), totals, least), packed["block"][0].as_py()
        block.pairs()
        block.triples()
        return pa.Table.from_batches([_deal(number, OF_PAIR, *block.of_pairs(), ranges)])

    def rate(packed: pa.Table, totals: pa.Table) -> pa.Table:
        rows = _unpacked(packed)
        block = _Block(rows, totals, least)
        model, count = block.model(tokens, types)
        start = block.tokens.start[:-1]
        return pa.table({
            "doc_id": pa.chunked_array([b["doc_id"] for b in rows]),
            "n_tokens": np.diff(block.tokens.start),
            "n_known": np.add.reduceat(count > 0, start, dtype=np.int64),
            "train_tokens": np.full(len(start), tokens),
            "base_score": np.add.reduceat(np.log10(model.root(count)), start),
            "score": np.add.reduceat(model.traverse(block.tokens, count, block.numbered()), start),
        })

    pairs = first.where(F.col("kind") == PAIR)
    second = _added(_with_totals(src, [pairs], triples, _DEALT))
    third = _added(_with_totals(src, [pairs, second.where(F.col("kind") == TRIPLE)], arcs_of_pairs, _DEALT))
    kinds = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return _with_totals(src, [first, second, third], rate, kinds)
