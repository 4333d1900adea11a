"""N-gram Jaccard join (operator 1): documents that share most word shingles.

Documents are sets of hashed 5-word shingles.  Two link when their sets'
Jaccard similarity is at least 0.8; the result is each document's component.

1. Documents with the same set are one class.
2. Classes that share minima of hash ranges are compared with the least class
   of each: a few pairs a class, so a group of near copies becomes stars.
3. All other links are found by prefixes.  In any order of shingles, two
   linked sets share one among the first n - ceil(0.8 n) + 1 of each.  The
   order puts shingles that are frequent in a sample last; it changes the cost
   only.  Only shingles whose documents lie in different components so far
   matter.  Their documents, in order of set size, form size-banded tiles;
   tiles whose sizes are compatible meet pairwise and compare bitmap
   signatures: a bit of one that the other lacks is an element that it lacks,
   so bit counts bound the overlap from above.  Tiles of one shingle are dealt
   out over tasks, and pairs beyond the bound never leave them.  Shingles of a
   few documents skip the tiles: their pairs meet the signatures once each.
4. What remains is checked by exact intersection of the sorted arrays.

Nothing is capped: every pair of sets that links ends in one component.

Defined cases: words are runs without blanks, A-Z lower-cased; a set of fewer
than 5 words is the whole sequence as one shingle; null, empty and blank texts
have no shingles and link with nothing; rows repeated under one id are one
node with a set each, and share its component; a null id stands for one
document that sorts after all others; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickline.llm.base import NULL_ID, arrow, arrow_iter, batch, partitions_for, real_id, staged, unstage, with_ids
from wickline.llm.components import components
from wickline.llm.text import U64, chunks, mix, ngram_hashes, word_hashes

WORDS = 5
#: Similarity of a link as a ratio.
NUMERATOR, DENOMINATOR = 4, 5
#: Hash ranges whose least shingle is a key of the star pass.
MINIMA = 8
#: Least classes that a class is compared with in the star pass.
LEADERS = 3
#: Documents sampled for frequent shingles, and how many must hold one.
SAMPLE, FREQUENT = 16_384, 6
TILE = 256
#: A shingle of at most so many documents is paired up without tiles.
FEW = 16
#: Signature words of pairs compared at a time.
PAIR_WORDS = 1 << 19
#: Widths of bitmap signatures in bits.
LEAST_WIDTH, MOST_WIDTH = 64, 16_384
#: Bits of the fixed-size filters on shingles and documents.
FILTER_BITS = 23
SALT = U64(0xA0761D6478BD642F)
#: Rows that a task is meant to take: documents with their prefixes, documents
#: whose prefixes' shingles it counts, contested shingles with their documents,
#: postings whose pairs it drops doubles of, pairs with their sets.
LABELLED_EACH, COUNTED_EACH, CONTESTED_EACH, POSTINGS_EACH, PAIRS_EACH = 50_000, 10_000, 100_000, 500_000, 10_000


def required(n: np.ndarray) -> np.ndarray:
    """Least overlap of a set of n shingles with any set that it links with."""
    return -(-NUMERATOR * n // DENOMINATOR)


def links(overlap, a, b):
    """Whether sets of a and b shingles with this overlap link."""
    return DENOMINATOR * overlap >= NUMERATOR * (a + b - overlap)


def _sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    for r0, r1, data, off in chunks(texts):
        shingles, at = ngram_hashes(*word_hashes(data, off), WORDS)
        for r in range(r1 - r0):
            s = np.sort(shingles[at[r] : at[r + 1]])
            if len(s) > 1:
                s = s[np.append(True, s[1:] != s[:-1])]
            yield s


def signature(s: np.ndarray) -> bytes:
    """A bitmap of hashed bits, four to eight for each element."""
    width = min(MOST_WIDTH, max(LEAST_WIDTH, 4 << max(len(s) - 1, 0).bit_length()))
    bits = np.zeros(width, np.uint8)
    bits[(mix(s) & U64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _fold(sig: bytes, width: int) -> np.ndarray:
    """The signature at a smaller width: bits modulo the width."""
    words = np.frombuffer(sig, np.uint64)
    return np.bitwise_or.reduce(words.reshape(-1, width // 64), axis=0)


def _bound(sig_a: np.ndarray, n_a: np.ndarray, sig_b: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Upper bound of the overlap; arrays broadcast, words on the last axis."""
    only_a = np.bitwise_count(sig_a & ~sig_b).sum(axis=-1, dtype=np.int64)
    only_b = np.bitwise_count(sig_b & ~sig_a).sum(axis=-1, dtype=np.int64)
    return np.minimum(n_a - only_a, n_b - only_b)


def _minima(s: np.ndarray) -> np.ndarray:
    """The least shingle of each hash range that holds one."""
    if not len(s):
        return s
    at = np.searchsorted(s, np.arange(MINIMA, dtype=np.uint64) << U64(61))
    ends = np.append(at[1:], len(s))
    return s[at[at < ends]]


def _prefix(s: np.ndarray, levels: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first shingles in the global order: frequent ones last, then by a hash."""
    order = mix(s ^ SALT)
    if len(levels[0]):
        at = np.minimum(np.searchsorted(levels[0], s), len(levels[0]) - 1)
        level = np.where(levels[0][at] == s, levels[1][at], 0).astype(np.uint64)
        order = (level << U64(58)) | (order >> U64(6))
    size = len(s) - int(required(np.int64(len(s)))) + 1
    if size >= len(s):
        return s
    return s[np.argpartition(order, size - 1)[:size]]


def frequent_shingles(src: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(sorted shingles, level) of those that many of a bounded sample of documents hold."""
    total = src.count()
    share = int(1_000_000 * min(1.0, SAMPLE / total)) if total else 0

    def explode(b: pa.RecordBatch) -> pa.RecordBatch:
        sets = list(_sets(b["text"]))
        return batch(shingle=np.concatenate(sets).view(np.int64))

    drawn = src.where(F.pmod(F.xxhash64("__id", F.lit(11)), F.lit(1_000_000)) < share)
    counts = arrow(drawn, explode, "shingle long").groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("n") >= FREQUENT).toArrow()
    shingles = counts["shingle"].to_numpy().view(np.uint64)
    place = np.argsort(shingles)
    level = np.minimum(np.log2(np.maximum(counts["n"].to_numpy(), 1)).astype(np.int64), 63)
    return shingles[place], level[place]


HEADS = "__id long, n long, f1 long, f2 long, minima array<long>, signature binary, prefix binary"


def heads(src: DataFrame, levels: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """A row for each document: set size, 128-bit set fingerprint, minima, signature, prefix."""

    def head(b: pa.RecordBatch) -> pa.RecordBatch:
        n, f1, f2, minima, sig, prefix = [], [], [], [], [], []
        for s in _sets(b["text"]):
            n.append(len(s))
            f1.append(int(mix(s).sum(dtype=np.uint64)))
            f2.append(int(mix(s ^ SALT).sum(dtype=np.uint64)))
            minima.append(_minima(s).view(np.int64))
            sig.append(signature(s))
            prefix.append(_prefix(s, levels).tobytes())
        return batch(
            __id=b["__id"], n=np.array(n, np.int64), f1=np.array(f1, np.uint64).view(np.int64), f2=np.array(f2, np.uint64).view(np.int64),
            minima=pa.array(minima, pa.list_(pa.int64())), signature=pa.array(sig, pa.binary()), prefix=pa.array(prefix, pa.binary()),
        )

    return arrow(src, head, HEADS)


def _bits(df: DataFrame, column: str) -> np.ndarray:
    """A filter of fixed size: one bit set for each value of a long column."""
    slot = F.shiftrightunsigned(F.xxhash64(column), 64 - FILTER_BITS)
    words = df.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("bits")
    )
    got = words.toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    out[got["word"].to_numpy()] = got["bits"].to_numpy()
    return np.unpackbits(out.view(np.uint8), bitorder="little")


def _sets_with_bit(src: DataFrame, bits: np.ndarray) -> DataFrame:
    """``__id`` and sorted shingles of the documents whose bit is set: all that
    matter, and some others.  One pass, so a task needs one Python worker."""
    packed = np.packbits(bits)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.unpackbits(packed).view(bool)
        for b in batches:
            b = b.filter(pa.array(flags[b["__slot"].to_numpy()]))
            if b.num_rows:
                yield batch(__id=b["__id"], shingles=pa.array([s.tobytes() for s in _sets(b["text"])], pa.binary()))

    slot = F.shiftrightunsigned(F.xxhash64("__id"), 64 - FILTER_BITS)
    return arrow_iter(src.withColumn("__slot", slot), whole, "__id long, shingles binary")


def _star_pairs(small: DataFrame) -> DataFrame:
    """(a, b): each class with the least classes that share most minima with it."""
    keyed = small.select("__id", "n", F.explode("minima").alias("key"))
    least = keyed.groupBy("key").agg(F.min("__id").alias("b"), F.count("*").alias("m")).where("m > 1").drop("m")
    shared = keyed.join(least, "key").where("b < __id").groupBy(F.col("__id").alias("a"), "b").agg(F.count("*").alias("m"))
    best = Window.partitionBy("a").orderBy(F.col("m").desc(), "b")
    return _within_bound(shared.withColumn("r", F.row_number().over(best)).where(F.col("r") <= LEADERS).select("a", "b"), small)


def _within_bound(pairs: DataFrame, small: DataFrame) -> DataFrame:
    """The pairs (a, b) that their sizes and signatures allow to link."""
    sigs = small.select("__id", "n", "signature")
    rows = pairs.join(sigs.toDF("a", "na", "sa"), "a").join(sigs.toDF("b", "nb", "sb"), "b")

    def near(b: pa.RecordBatch) -> pa.RecordBatch | None:
        keep = []
        for i, (na, nb, sa, sb) in enumerate(zip(*(b[c].to_pylist() for c in ("na", "nb", "sa", "sb")), strict=True)):
            width = 8 * min(len(sa), len(sb))
            if links(min(na, nb), na, nb) and links(int(_bound(_fold(sa, width), na, _fold(sb, width), nb)), na, nb):
                keep.append(i)
        return batch(a=b["a"].take(pa.array(keep, pa.int64())), b=b["b"].take(pa.array(keep, pa.int64()))) if keep else None

    return arrow(rows, near, "a long, b long")


def exact_links(src: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link, by intersection of the sorted arrays."""
    needed = pairs.select(F.col("a").alias("__id")).unionByName(pairs.select(F.col("b").alias("__id"))).distinct()

    sets = _sets_with_bit(src, _bits(needed, "__id"))
    rows = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")

    def check(b: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for sa, sb in zip(b["sa"], b["sb"], strict=True):
            x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (sa, sb))
            both = np.sort(np.concatenate([x, y]), kind="stable")
            keep.append(bool(links(int((both[1:] == both[:-1]).sum()), len(x), len(y))))
        kept = pa.array(keep)
        return batch(a=b["a"].filter(kept), b=b["b"].filter(kept))

    return arrow(rows, check, "a long, b long")


def _postings(labelled: DataFrame, flags: np.ndarray | None) -> DataFrame:
    """(key, __id, n, component) of the prefixes' shingles whose flag is set;
    (key, component) of all without flags."""
    packed = None if flags is None else np.packbits(flags)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None if packed is None else np.unpackbits(packed).astype(bool)
        for b in batches:
            keys = np.frombuffer(b"".join(x.as_py() for x in b["prefix"]), np.uint64)
            size = np.array([len(x.as_py()) // 8 for x in b["prefix"]], np.int64)
            row = np.repeat(np.arange(b.num_rows), size)
            if wanted is None:
                yield batch(key=keys.view(np.int64), component=b["component"].to_numpy()[row])
                continue
            hit = np.flatnonzero(wanted[mix(keys) >> U64(64 - FILTER_BITS)])
            for i in range(0, len(hit), 50_000):
                at = hit[i : i + 50_000]
                yield b.select(["__id", "n", "component"]).take(pa.array(row[at])).append_column("key", pa.array(keys[at].view(np.int64)))

    kinds = "key long, component long" if flags is None else "__id long, n long, component long, key long"
    return arrow_iter(labelled, spread, kinds)


def _contested(labelled: DataFrame) -> DataFrame:
    """(key): prefix shingles held in more than one component so far."""
    spread = _postings(labelled, None).groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return spread.where("low < high").select("key")


def _key_flags(keys: DataFrame) -> np.ndarray:
    """The fixed-size filter over contested shingles, by their mixed hash."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
        for b in batches:
            slot = mix(b["key"].to_numpy().view(np.uint64)) >> U64(64 - FILTER_BITS)
            np.bitwise_or.at(words, slot >> U64(6), U64(1) << (slot & U64(63)))
        some = np.flatnonzero(words)
        yield batch(word=some.astype(np.int32), bits=words[some].view(np.int64))

    got = arrow_iter(keys, mark, "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    out[got["word"].to_numpy()] = got["bits"].to_numpy()
    return np.unpackbits(out.view(np.uint8), bitorder="little")


def _ranked(postings: DataFrame) -> DataFrame:
    """Postings in order of set size within their shingle, with their rank and number."""
    of_key = Window.partitionBy("key")
    rank = F.row_number().over(of_key.orderBy("n", "__id"))
    return postings.withColumns({"rank": rank, "m": F.count("*").over(of_key)})


def _few(ranked: DataFrame) -> DataFrame:
    """(a, b) of different components and compatible sizes that share a
    shingle of at most ``FEW`` documents."""
    dealt = ranked.where(F.col("m") <= FEW).repartition("key").sortWithinPartitions("key", "rank")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for b in batches:
            now = [b[c].to_numpy() for c in ("key", "__id", "n", "component")]
            if held is not None:
                now = [np.concatenate([h, x]) for h, x in zip(held, now, strict=True)]
            key, ids, n, component = now
            out_a, out_b = [], []
            for d in range(1, min(FEW, len(key))):
                same = (key[d:] == key[:-d]) & (component[d:] != component[:-d]) & links(n[:-d], n[:-d], n[d:])
                at = np.flatnonzero(same)
                out_a.append(np.maximum(ids[at], ids[at + d]))
                out_b.append(np.minimum(ids[at], ids[at + d]))
            held = [x[-FEW:] for x in now]  # pairs seen twice are dropped below
            if out_a:
                both = np.unique(np.stack([np.concatenate(out_a), np.concatenate(out_b)], axis=1), axis=0)
                if len(both):
                    yield batch(a=np.ascontiguousarray(both[:, 0]), b=np.ascontiguousarray(both[:, 1]))

    return arrow_iter(dealt.select("key", "__id", "n", "component"), pairs, "a long, b long").where("a <> b")


def _tiles(ranked: DataFrame) -> DataFrame:
    """Postings with the tile of their shingle and every tile that it meets.

    A shingle's documents in order of set size are cut into tiles; a tile
    meets itself and the later tiles that start with a compatible size."""
    placed = ranked.withColumn("tile", F.floor((F.col("rank") - 1) / TILE).cast("int"))
    bands = placed.groupBy("key", "tile").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    later = bands.toDF("key", "other", "other_low", "other_high")
    met = bands.join(later, "key").where((F.col("other") >= F.col("tile")) & (NUMERATOR * F.col("other_low") <= DENOMINATOR * F.col("high")))
    meets = met.select("key", F.col("tile").alias("left"), F.col("other").alias("right"))
    sides = meets.select("key", F.col("left").alias("tile"), "left", "right").unionByName(
        meets.where("left < right").select("key", F.col("right").alias("tile"), "left", "right")
    )
    return placed.join(sides, ["key", "tile"])


def _many(ranked: DataFrame, small: DataFrame) -> DataFrame:
    """(a, b) of different components that share a shingle of more documents
    and whose signatures allow a link.  A pair that shares several of them
    comes from the least one only."""
    held = ranked.where(F.col("m") > FEW)
    keys = held.groupBy("__id", "n").agg(F.sort_array(F.collect_set("key")).alias("keys"))  # of one prefix
    sigs = small.select("__id", "n", "signature").join(keys, ["__id", "n"])
    dealt = _tiles(held).join(sigs, ["__id", "n"])
    dealt = dealt.repartition("key", "left", "right").sortWithinPartitions("key", "left", "right", "tile", "n", "__id")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for b in batches:
            t = pa.Table.from_batches([b])
            rest = t if rest is None else pa.concat_tables([rest, t])
            place = _group_starts(rest)
            if len(place) > 1:
                yield from _compare(rest.slice(0, int(place[-1])), place)
                rest = rest.slice(int(place[-1]))
        if rest is not None and rest.num_rows:
            yield from _compare(rest, np.append(_group_starts(rest), rest.num_rows))

    rows = dealt.select("key", "left", "right", "tile", "__id", "n", "component", "signature", "keys")
    return arrow_iter(rows, compare, "a long, b long")


def _candidates(ranked: DataFrame, small: DataFrame) -> DataFrame:
    """(a, b) of different components whose sizes and signatures allow a link."""
    few = _within_bound(_few(ranked).distinct(), small)
    return few.unionByName(_many(ranked, small)).distinct()


def _group_starts(t: pa.Table) -> np.ndarray:
    new = np.ones(t.num_rows, bool)
    new[1:] = False
    for c in ("key", "left", "right"):
        x = t[c].to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _compare(t: pa.Table, place: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Pairs of every group; ``place``: group starts and the end."""
    t = t.combine_chunks()
    ids, n, component, tile = (t[c].to_numpy() for c in ("__id", "n", "component", "tile"))
    sigs = [x.as_py() for x in t["signature"]]
    size = np.array([len(x) for x in sigs])
    key, held = t["key"].to_numpy(), [x.values.to_numpy() for x in t["keys"]]
    out_a, out_b = [], []
    for lo, hi in zip(place[:-1].tolist(), place[1:].tolist(), strict=True):
        c = component[lo:hi]
        if (c == c[0]).all():
            continue
        cut = lo + int(np.searchsorted(tile[lo:hi], tile[hi - 1])) if tile[lo] != tile[hi - 1] else lo
        left, right = (np.arange(lo, hi), np.arange(lo, hi)) if cut == lo else (np.arange(lo, cut), np.arange(cut, hi))
        ok = (component[left][:, None] != component[right]) & links(np.minimum(n[left][:, None], n[right]), n[left][:, None], n[right])
        if cut == lo:
            ok = np.triu(ok, 1)
        x, y = np.nonzero(ok)
        if not len(x):
            continue
        x, y = left[x], right[y]
        narrow = np.minimum(size[x], size[y])
        for width in np.unique(narrow).tolist():  # sizes of a pair are near, so are its widths
            u, v = x[narrow == width], y[narrow == width]
            rows, at = np.unique(np.concatenate([u, v]), return_inverse=True)
            folded = np.stack([_fold(sigs[i], 8 * width) for i in rows.tolist()])
            step = max(1, PAIR_WORDS // folded.shape[1])
            for i in range(0, len(u), step):
                p, q = u[i : i + step], v[i : i + step]
                bound = _bound(folded[at[i : i + len(p)]], n[p], folded[at[len(u) + i : len(u) + i + len(p)]], n[q])
                near = np.flatnonzero(links(bound, n[p], n[q]))
                first = [np.intersect1d(held[x], held[y], assume_unique=True)[0] == key[lo] for x, y in zip(p[near].tolist(), q[near].tolist(), strict=True)]
                near = near[np.array(first, bool)]
                out_a.append(ids[p[near]])
                out_b.append(ids[q[near]])
    if out_a:
        a, b = np.concatenate(out_a), np.concatenate(out_b)
        pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1), axis=0)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        if len(pairs):
            yield batch(a=np.ascontiguousarray(pairs[:, 0]), b=np.ascontiguousarray(pairs[:, 1]))


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and class_id (the least document with
    the same set), a row for each row of ``df``."""
    src = with_ids(df, id_col, text_col).select("__id", F.col(text_col).alias("text"))
    head = staged(heads(src, frequent_shingles(src)), "heads")
    rows_for = partial(partitions_for, df.sparkSession)
    documents = head.count()
    small = head.where("n > 0").select("__id", "n", "f1", "f2", "minima", "signature")
    classes = small.groupBy("f1", "f2", "n").agg(F.min("__id").alias("class"))
    member = staged(small.select("__id", "f1", "f2", "n").distinct().join(classes, ["f1", "f2", "n"]), "classes", rows_for(documents, LABELLED_EACH))
    same = member.where("__id <> class").select(F.col("__id").alias("u"), F.col("class").alias("v"))

    leaders = small.join(member.where("__id = class").select("__id", "f1", "f2", "n"), ["__id", "f1", "f2", "n"]).dropDuplicates(["__id", "f1", "f2", "n"])
    stars = staged(_star_pairs(leaders), "star-pairs", rows_for(documents, LABELLED_EACH))
    first = staged(exact_links(src, stars).toDF("u", "v"), "star-links", rows_for(stars.count(), PAIRS_EACH))
    before = components(same.unionByName(first))

    known = member.join(before.withColumnRenamed("id", "__id"), "__id", "left")
    known = known.select("__id", "f1", "f2", "n", F.coalesce("component", "__id").alias("component")).where("__id = class")
    columns = head.where("n > 0").select("__id", "f1", "f2", "n", "prefix").dropDuplicates(["__id", "f1", "f2", "n"])
    labelled = staged(columns.join(known, ["__id", "f1", "f2", "n"]).select("__id", "n", "component", "prefix"), "labelled", rows_for(documents, LABELLED_EACH))
    contested = staged(_contested(labelled), "contested", rows_for(documents, COUNTED_EACH))
    postings = _postings(labelled, _key_flags(contested)).join(contested, "key")
    ranked = staged(_ranked(postings), "postings", rows_for(contested.count(), CONTESTED_EACH))
    pairs = staged(_candidates(ranked, small), "pairs", rows_for(ranked.count(), POSTINGS_EACH))
    second = staged(exact_links(src, pairs).toDF("u", "v"), "links", rows_for(pairs.count(), PAIRS_EACH))
    for done in (stars, labelled, contested, pairs):
        unstage(done)
    final = components(same.unionByName(first).unionByName(second))

    rows = head.select("__id", "f1", "f2", F.col("n").alias("n_shingles"))
    rows = rows.join(final.withColumnRenamed("id", "__id"), "__id", "left")
    rows = rows.join(member.select("__id", "f1", "f2", "class"), ["__id", "f1", "f2"], "left")
    return rows.select(
        real_id().alias("doc_id"),
        "n_shingles",
        _real(F.coalesce("component", "__id")).alias("component_id"),
        _real(F.coalesce("class", "__id")).alias("class_id"),
    )


def _real(column):
    return F.when(column != NULL_ID, column)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are the least document of their component,
    unchanged; documents without shingles all stay."""
    groups = jaccard_components(docs, id_col, text_col).where("NOT doc_id <=> component_id")
    gone = groups.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("__gone")).distinct()
    return docs.join(gone, F.coalesce(docs[id_col].cast("long"), F.lit(NULL_ID)) == gone["__gone"], "left_anti")
