"""Near-duplicate documents by 64-bit SimHash, linked through shared bit blocks.

Two fingerprints that differ in at most d bits agree wholly on all but d of any blocks the
bits are cut into. Fingerprints are therefore joined on what they hold outside each choice of
three of six blocks (20 keys of about 33 bits), and candidates are verified by XOR and bit
count. A key that more than ``bucket_rows`` different fingerprints share is not compared pair
by pair: its members are dealt again by the same argument, over eight blocks of the free bits
(56 keys). At most 13 bits are free then, so such a group holds at most 8,192 fingerprints
however large the corpus is, and no link is lost.

Groups give spanning stars rather than all pairs; components follow from the stars.

``keep_similar`` goes by the similarity of word shingles instead, and loses no similar pair. Sets
of similarity t share k of their first n - t * n + k shingles in any common order: shingles
frequent in a sample come last, the others by hash. Texts that share fewer with all others (k: a
twentieth) are out, and of the shingles shared, all but the k - 1 most frequent must still meet.
Of the rest, two fingerprints of the set of words first name spanning links of large groups by
the same blocks; then every pair that meets and is not connected yet is taken, unless its sizes
or the parities of 512 bins of shingles rule it out. A candidate counts only if the texts'
shingles really are that similar.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditspark.llm.common import cut, rows_of, small
from creditspark.llm.components import stars

SEED = 42
MAX_BITS = 3
BUCKET_ROWS = 4096
_CHUNK = 1 << 15
SHINGLE = 5
SIMILARITY = 0.8
SET_BITS = 4
SET_PARTS = 6
_FINER = 8  # parts of the open bits, for crowded keys
_BINS = 512  # of shingles, whose parities bound the difference of two sets
SAMPLED = 16  # one text of so many shows which shingles are frequent
FREQUENT = 1 << 14  # shingles that come last, at most
SHARE = 20  # similar sets have one of so many shingles, and one more, in common among their first


def fingerprint(text: str | None, width: int = 3) -> int:
    """Unsigned SimHash of a text's word shingles (XXH64, seed 42; repeats count); no words: 0."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()  # bytes: A-Z only, and just the ASCII blanks
    if not words:
        return 0
    if len(words) < width:
        return xxh64_intdigest(b" ".join(words), SEED)  # a bit of one hash is in over half of it
    join, runs = b" ".join, zip(*(words[i:] for i in range(width)))
    hashes = np.array([xxh64_intdigest(join(run), SEED) for run in runs], dtype=">u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _CHUNK):
        octets = hashes[at : at + _CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts in rows_of(batches):
        values = np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(values)], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): one fingerprint a row, as a signed long."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _fingerprints, "doc_id long, fp long"
    )


def _spread(bits: list[int], parts: int) -> list[list[int]]:
    return [list(x) for x in np.array_split(bits, parts)]


def _masks(bits: list[int], parts: int, max_bits: int) -> list[int]:
    """One mask for each choice of the parts that may differ: the bits that must agree, as signed longs."""
    every = sum(1 << b for b in bits)
    found = []
    for open_parts in combinations(_spread(bits, parts), max_bits):
        mask = every & ~sum(1 << int(b) for part in open_parts for b in part)
        found.append(mask - (1 << 64) if mask >> 63 else mask)
    return found


def _star_edges(group: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Spanning stars of the links within one group of different fingerprints.

    A flood from each unvisited member: a member reached is compared once with those not yet
    reached, so memory stays linear and no pair is written.
    """
    left, edges = group, []
    while len(left):
        root, frontier = int(left[0]), [left[0]]
        left = left[1:]
        while frontier and len(left):
            near = np.bitwise_count((left ^ frontier.pop()).view(np.uint64)) <= max_bits
            reached, left = left[near], left[~near]
            frontier.extend(reached)
            edges.extend((root, int(x)) for x in reached)
    return edges


def _link(batches: Iterator[pa.RecordBatch], bucket_rows: int, max_bits: int) -> Iterator[pa.RecordBatch]:
    """Stars within runs of equal (part, key); rows come sorted. Members of larger runs come out as they are.

    ``part`` is null on edges (key, fp); members to be dealt again keep their part and key.
    """

    def out(parts, keys, fps):
        return pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.int32()), pa.array(keys, pa.int64()), pa.array(fps, pa.int64())], ["part", "key", "fp"]
        )

    part, key, fp = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)
    passing = None  # the large run whose members are being handed on
    for batch in chain(batches, [None]):  # None: the end
        if batch is not None:
            p, k, f = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            part, key, fp = np.r_[part, p], np.r_[key, k], np.r_[fp, f]
        if not len(fp):
            continue
        starts = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (key[1:] != key[:-1])])
        sizes = np.diff(np.r_[starts, len(fp)])
        open_run = len(starts) - 1 if batch is not None else len(starts)  # may go on in the next batch
        keep, edges, done = len(fp), [], np.zeros(len(starts), bool)
        if passing is not None and passing == (part[0], key[0]):
            yield out(part[: sizes[0]], key[: sizes[0]], fp[: sizes[0]])
            done[0] = True
            passing = passing if open_run == 0 else None
        for i in np.flatnonzero((sizes > bucket_rows) & ~done):
            s = slice(starts[i], starts[i] + sizes[i])
            yield out(part[s], key[s], fp[s])
            done[i] = True
            passing = (part[s.start], key[s.start]) if i == open_run else None
        if open_run < len(starts) and not done[open_run]:
            keep, done[open_run] = starts[open_run], True
        two = starts[(sizes == 2) & ~done]
        two = two[np.bitwise_count((fp[two] ^ fp[two + 1]).view(np.uint64)) <= max_bits]
        for i in np.flatnonzero((sizes > 2) & ~done):
            edges += _star_edges(fp[starts[i] : starts[i] + sizes[i]], max_bits)
        a = np.r_[fp[two], np.array([x for x, _ in edges], np.int64)]
        b = np.r_[fp[two + 1], np.array([x for _, x in edges], np.int64)]
        if len(a):
            yield out([None] * len(a), a, b)
        part, key, fp = part[keep:], key[keep:], fp[keep:]


def _grouped(keyed: DataFrame, bucket_rows: int, max_bits: int) -> DataFrame:
    return (
        keyed.repartition("part", "key")
        .sortWithinPartitions("part", "key", "fp")
        .mapInArrow(lambda batches: _link(batches, bucket_rows, max_bits), "part int, key long, fp long")
    )


def links(distinct: DataFrame, max_bits: int = MAX_BITS, parts: int = 6, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b): stars spanning all links among ``distinct`` (column fp, each value once)."""
    masks = _masks(list(range(64)), parts, max_bits)

    def keys(mask_list, value):
        return F.array(
            *[F.struct(F.lit(i).alias("part"), value.bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(mask_list)]
        )

    first = distinct.select(F.explode(keys(masks, F.col("fp"))).alias("k"), "fp").select("k.part", "k.key", "fp")
    found = cut(_grouped(first, bucket_rows, max_bits))
    edges = found.where("part is null").select(F.col("key").alias("a"), F.col("fp").alias("b"))
    # Members of large buckets: the open bits once more in eight parts, three of which may differ.
    finer = []
    for i, mask in enumerate(masks):
        open_bits = [b for b in range(64) if not (mask >> b) & 1]
        finer += [(i, mask | m) for m in _masks(open_bits, 8, max_bits)]
    again = F.array(*[F.array(*[F.lit(m) for j, m in finer if j == i]) for i in range(len(masks))])
    second = (
        found.where("part is not null")
        .select(F.posexplode(F.element_at(again, F.col("part") + 1)).alias("j", "mask"), "part", "fp")
        .select(
            (F.col("part") * 64 + F.col("j")).cast("int").alias("part"),
            F.col("mask").bitwiseAND(F.col("fp")).alias("key"),
            "fp",
        )
    )
    more = _grouped(second, 1 << 62, max_bits).select(F.col("key").alias("a"), F.col("fp").alias("b"))
    return edges.unionByName(more)


def _components(marked: DataFrame, max_bits: int, bucket_rows: int) -> DataFrame:
    """(fp, root): every fingerprint and the least one (as a signed long) of its component."""
    nodes = marked.select("fp").distinct()
    roots = stars(links(nodes, max_bits, bucket_rows=bucket_rows))
    return nodes.join(roots, nodes["fp"] == roots["node"], "left").select(nodes["fp"], F.coalesce("root", nodes["fp"]).alias("root"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_bits: int = MAX_BITS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per input row.

    ``component_id`` is the smallest id that chains of links of at most ``max_bits`` bits reach.
    Null, empty and wordless texts have fingerprint zero and link like any other. Repeated ids
    and equal texts stay separate rows. A null id never names a component unless its
    component has no other. Other columns of ``docs`` play no part. No rows give no rows.
    """
    marked = cut(fingerprints(docs, id_col, text_col))
    firsts = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    rooted = _components(marked, max_bits, bucket_rows).join(firsts, "fp")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(least, "root").select(F.col("fp").alias("_fp"), "component_id")
    return marked.join(named, marked["fp"] == F.col("_fp")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_bits: int = MAX_BITS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row of ``docs`` for each component of ``near_duplicates``: the least id, nulls last.

    Of rows that share it, the one whose text hashes least; of rows equal in both, any one.
    """
    key = [F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("d"), F.xxhash64(F.col(text_col)).alias("m")]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    whole = docs.select(F.col(text_col).alias("text"), *key, row)
    # the fingerprint travels with the hash of its text
    marked = cut(whole.select("d", "text", "m").mapInArrow(_with_marks, "d long, m long, fp long"))
    least = marked.groupBy("fp").agg(F.min(F.struct("d", "m")).alias("first"))
    chosen = (
        _components(marked, max_bits, bucket_rows)
        .join(least, "fp")
        .groupBy("root")
        .agg(F.min("first").alias("first"))
        .select(F.col("first.d").alias("cd"), F.col("first.m").alias("cm"))
    )
    one = Window.partitionBy("d", "m").orderBy("d")
    return (
        whole.join(chosen, (F.col("d") == F.col("cd")) & (F.col("m") == F.col("cm")))
        .withColumn("n", F.row_number().over(one))
        .where("n = 1")
        .select("row.*")
    )


def _with_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts, marks in rows_of(batches):
        values = np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(marks, pa.int64()), pa.array(values)], ["d", "m", "fp"])


def _mix(h: np.ndarray) -> np.ndarray:
    """Another hash of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _word_hashes(text: str | None) -> np.ndarray:
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    return np.fromiter((xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words))


def shingle_set(words: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """The different runs of ``width`` words as sorted hashes; fewer words: one run of them all; none: none."""
    if not len(words):
        return words
    count = min(width, len(words))
    runs = np.full(len(words) - count + 1, count, np.uint64)
    for i in range(count):
        runs = _mix(runs * np.uint64(0x9E3779B97F4A7C15) + words[i : i + len(runs)])
    return np.unique(runs)


def _set_fingerprint(hashes: np.ndarray) -> int:
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _CHUNK):
        octets = hashes[at : at + _CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _least_overlap(count: int, similarity: float) -> int:
    """What a set of ``count`` has in common with any set that is similar to it, at least."""
    return max(1, math.ceil(similarity * count - 1e-9))


def _first(runs: np.ndarray, last: np.ndarray, rank: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles of a set, in order of hash, but with those of ``last`` by rank at the end.

    A similar set has ``_shared`` of them among its own first ones, or more.
    """
    at = np.minimum(np.searchsorted(last, runs), max(len(last) - 1, 0))
    late = last[at] == runs if len(last) else np.zeros(len(runs), bool)
    ordered = np.r_[runs[~late], runs[late][np.argsort(rank[at[late]])]] if late.any() else runs
    return ordered[: len(runs) - _least_overlap(len(runs), similarity) + 1 + len(runs) // SHARE] if len(runs) else runs


def _shared(count: int, similarity: float) -> int:
    """How many of its first shingles a set of ``count`` shares with any similar set, which has ``_least_overlap`` or more."""
    return 1 + _least_overlap(count, similarity) // SHARE


def _parities(runs: np.ndarray) -> np.ndarray:
    """Whether the number of shingles in each of ``_BINS`` bins is odd; sets differ by as many shingles as these, or more."""
    odd = np.bincount((runs % np.uint64(_BINS)).astype(np.int64), minlength=_BINS) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([a.view(np.int64) for a in arrays])))


_MARKS = "d long, m long, s long, f0 long, f1 long, n long, shared long, odd array<long>, first array<long>"


def _set_marks(
    batches: Iterator[pa.RecordBatch], width: int, similarity: float, last: np.ndarray, rank: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """A hash s of the text's shingle set (0: no words), two fingerprints of its set of words, the set's size, parities and first shingles."""
    for ids, texts, marks in rows_of(batches):
        found, odd, first = [], [], []
        for text in texts:
            words = _word_hashes(text)
            runs, different = shingle_set(words, width), np.unique(words)
            s = int(_mix(np.bitwise_xor.reduce(_mix(runs)) + runs[:1])[0]) | 1 if len(runs) else 0
            found.append((s, _set_fingerprint(different), _set_fingerprint(_mix(different)), len(runs), _shared(len(runs), similarity)))
            odd.append(_parities(runs))
            first.append(_first(runs, last, rank, similarity))
        values = np.array(found, dtype=np.uint64).reshape(-1, 5).view(np.int64)
        columns = [pa.array(ids, pa.int64()), pa.array(marks, pa.int64()), *[pa.array(values[:, i].copy()) for i in range(5)]]
        yield pa.RecordBatch.from_arrays([*columns, _lists(odd), _lists(first)], ["d", "m", "s", "f0", "f1", "n", "shared", "odd", "first"])


def _frequent(texts: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles found more than once in a sample of the different texts (m, text), sorted, and their ranks, most frequent last.

    They only decide the order in which shingles are looked at: any order gives the same pairs, this one fewer candidates.
    """
    sample = texts.where(f"pmod(m, {SAMPLED}) = 0").dropDuplicates(["m"]).select("m", "text")
    runs = sample.mapInArrow(lambda b: _runs(b, width), "t long").groupBy("t").count().where("count > 1")
    rows = runs.orderBy(F.desc("count"), "t").limit(FREQUENT).collect()
    found = np.array([r.t for r in rows], np.int64).view(np.uint64)
    at = np.argsort(found)
    return found[at], (len(rows) - np.arange(len(rows)))[at]


def _runs(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for _, texts in rows_of(batches):
        runs = np.concatenate([shingle_set(_word_hashes(t), width) for t in texts])
        yield pa.RecordBatch.from_arrays([pa.array(runs.view(np.int64))], ["t"])


def _met(marked: DataFrame, nodes: DataFrame) -> DataFrame:
    """(t, s): shingles at which every two similar sets meet."""
    at = Window.partitionBy("t")
    each = marked.select(F.explode("first").alias("t"), "s")
    ends = each.select("t", "s", *[f("s").over(at).alias(c) for f, c in ((F.min, "least"), (F.max, "most"), (F.count, "times"))])
    hits = ends.where("least <> most").select("t", "s", "times").distinct()
    # Two similar sets share that many, so one at least that is not among the last of either.
    rare = Window.partitionBy("s")
    places = hits.join(nodes.select("s", "shared"), "s").select(
        "*", F.row_number().over(rare.orderBy("times", "t")).alias("place"), F.count("*").over(rare).alias("hits")
    )
    return _open(cut(places.where("place <= hits - shared + 1").select("t", "s")), "s")


def _open(met: DataFrame, mark: str) -> DataFrame:
    """The rows of ``met`` whose t more than one ``mark`` has."""
    ends = met.groupBy("t").agg(F.min(mark).alias("least"), F.max(mark).alias("most"))
    return met.join(ends.where("least <> most").select("t"), "t")


def _unconnected(met: DataFrame, nodes: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """(a, b), each pair once: sets with a first shingle in common and different roots, unless sizes or parities rule it out."""
    rooted = met.join(roots.withColumnRenamed("node", "s"), "s", "left").select("t", "s", F.coalesce("root", "s").alias("root"))
    # Shingles whose sets are all connected are out before the pairs are made.
    named = _open(rooted, "root").join(nodes.select("s", "n", "odd"), "s")
    near = cut(named.select("t", "s", "root", "n", *[F.col("odd")[i].alias(f"o{i}") for i in range(_BINS // 64)]))
    a, b = near.alias("a"), near.alias("b")
    apart = reduce(lambda x, y: x + y, [F.bit_count(F.col(f"a.o{i}").bitwiseXOR(F.col(f"b.o{i}"))) for i in range(_BINS // 64)])
    sizes = F.col("a.n") + F.col("b.n")
    fits = (F.least("a.n", "b.n") >= similarity * F.greatest("a.n", "b.n") - 1e-9) & (
        apart * (1 + similarity) <= (1 - similarity) * sizes + 1e-6
    )
    met_at = (F.col("a.t") == F.col("b.t")) & (F.col("a.s") < F.col("b.s")) & (F.col("a.root") != F.col("b.root"))
    return a.join(b, met_at & fits).select(F.col("a.s").alias("a"), F.col("b.s").alias("b")).distinct()


def _tree(s: np.ndarray, fp: np.ndarray, other: np.ndarray, max_bits: int, wide: int) -> list[tuple[int, int]]:
    """Links (a, b) that span those of at most ``max_bits`` bits in a group, the closest by both fingerprints first.

    A group of more than ``wide`` members is flooded instead: each member reached is linked to the one that
    reached it and compared no more, so that memory stays linear and dense groups take few rounds.
    """
    apart = lambda f, i: np.bitwise_count((f ^ f[i]).view(np.uint64)).astype(np.int32)
    edges, far = [], np.int32(1 << 20)
    if len(s) > wide:
        left = np.arange(len(s))
        while len(left):
            frontier, left = [left[0]], left[1:]
            while frontier and len(left):
                at = frontier.pop(0)
                near = np.bitwise_count((fp[left] ^ fp[at]).view(np.uint64)) <= max_bits
                edges += [(int(s[at]), int(s[x])) for x in left[near]]
                frontier.extend(left[near])
                left = left[~near]
        return edges
    gap, by, todo, at = np.full(len(s), far), np.zeros(len(s), np.int64), np.ones(len(s), bool), 0
    for _ in range(len(s) - 1):
        todo[at] = False
        own = apart(fp, at)
        both = own + apart(other, at)
        better = todo & (own <= max_bits) & (both < gap)
        gap[better], by[better] = both[better], at
        at = int(np.argmin(np.where(todo, gap, far + 1)))
        if gap[at] < far:
            edges.append((int(s[by[at]]), int(s[at])))
    return edges


_MEMBER = ["part", "key", "s", "fp", "other"]


def _trees(batches: Iterator[pa.RecordBatch], bucket_rows: int, max_bits: int, last: bool) -> Iterator[pa.RecordBatch]:
    """``_tree`` of runs of equal (part, key), as rows (null, null, a, b, null); rows come sorted.

    Unless this is the ``last`` dealing, members of runs of more than ``bucket_rows`` come out as they are.
    """
    types = [pa.int32(), *[pa.int64()] * 4]

    def edges_out(edges):
        a, b = (list(x) for x in zip(*edges))
        none = [None] * len(a)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((none, none, a, b, none), types)], _MEMBER)

    held = [np.empty(0, np.int32), *[np.empty(0, np.int64)] * 4]
    passing = None  # the crowded run whose members are being handed on
    for batch in chain(batches, [None]):  # None: the end
        if batch is not None:
            held = [np.r_[h, c.to_numpy(zero_copy_only=False)] for h, c in zip(held, batch.columns)]
        part, key, s, fp, other = held
        if not len(s):
            continue
        starts = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (key[1:] != key[:-1])])
        ends = np.r_[starts[1:], len(s)]
        edges, keep = [], len(s)
        for i in np.flatnonzero((ends - starts > 1) | (np.arange(len(starts)) == len(starts) - 1) | (np.arange(len(starts)) == 0)):
            run, name = slice(starts[i], ends[i]), (part[starts[i]], key[starts[i]])
            is_open = batch is not None and i == len(starts) - 1
            if not last and (passing == name or ends[i] - starts[i] > bucket_rows):
                yield pa.RecordBatch.from_arrays([pa.array(h[run], t) for h, t in zip(held, types)], _MEMBER)
                passing = name if is_open else None
            elif is_open:
                keep = starts[i]
            elif ends[i] - starts[i] > 1:
                edges += _tree(s[run], fp[run], other[run], max_bits, bucket_rows)
        if edges:
            yield edges_out(edges)
        held = [h[keep:] for h in held]


def candidates(nodes: DataFrame, max_bits: int = SET_BITS, parts: int = SET_PARTS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b), each pair once: links spanning the ``nodes`` (s, f0, f1) within ``max_bits`` bits by either fingerprint."""
    masks = _masks(list(range(64)), parts, max_bits)
    n, first = len(masks), ["f0", "f1"]
    keys = F.array(
        *[
            F.struct(F.lit(k * n + i).alias("part"), F.col(f).bitwiseAND(F.lit(m)).alias("key"), F.col(f).alias("fp"), F.col(g).alias("other"))
            for k, (f, g) in enumerate([first, first[::-1]])
            for i, m in enumerate(masks)
        ]
    )

    def dealt(keyed, last):
        rows = keyed.select(*_MEMBER).repartition("part", "key").sortWithinPartitions("part", "key", "s")
        return rows.mapInArrow(lambda b: _trees(b, bucket_rows, max_bits, last), "part int, key long, s long, fp long, other long")

    found = cut(dealt(nodes.select("s", F.explode(keys).alias("k")).select("k.*", "s"), False))
    finer = [[m | x for x in _masks([b for b in range(64) if not (m >> b) & 1], _FINER, max_bits)] for m in masks]
    again = F.array(*[F.array(*map(F.lit, x)) for x in finer])
    crowded = (
        found.where("part is not null")
        .select("*", F.posexplode(F.get(again, F.col("part") % n)).alias("j", "mask"))
        .select(
            (2 * n + F.col("part") * len(finer[0]) + F.col("j")).cast("int").alias("part"),
            F.col("mask").bitwiseAND(F.col("fp")).alias("key"),
            *_MEMBER[2:],
        )
    )
    links = found.unionByName(dealt(crowded, True)).where("part is null")
    return links.select(F.least("s", "fp").alias("a"), F.greatest("s", "fp").alias("b")).distinct()


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for nodes, texts in rows_of(batches, 64):
        sets = [shingle_set(_word_hashes(t), width).tobytes() for t in texts]
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], ["s", "runs"])


def _alike(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    for a, b, left, right in rows_of(batches, 64):
        kept = []
        for x, y, p, q in zip(a, b, left, right):
            p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
            if min(len(p), len(q)) >= similarity * max(len(p), len(q)):
                both = len(np.intersect1d(p, q, assume_unique=True))
                if both >= similarity * (len(p) + len(q) - both) - 1e-9:
                    kept.append((x, y))
        columns = [[x for x, _ in kept], [y for _, y in kept]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])


def keep_similar(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE,
    similarity: float = SIMILARITY,
    max_bits: int = SET_BITS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row of ``docs`` for each group of texts that chains of similar ones connect: the least id, nulls last.

    Texts are similar if their sets of ``width``-word shingles (A-Z lower-cased; fewer words: the
    whole sequence) have a Jaccard similarity of ``similarity`` or more. No such pair is lost and
    none goes unverified; ``max_bits`` and ``bucket_rows`` only decide how many are connected
    before all others are compared. Null, empty and wordless texts are one group. Of rows that
    share the least id, the one whose text hashes least; of rows equal in both, any one. No rows
    give no rows.
    """
    key = [F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("d"), F.xxhash64(F.col(text_col)).alias("m")]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    whole = docs.select(F.col(text_col).alias("text"), *key, row)
    last, rank = _frequent(whole.select("m", "text"), width)
    marked = cut(whole.select("d", "text", "m").mapInArrow(lambda b: _set_marks(b, width, similarity, last, rank), _MARKS))
    firsts = marked.groupBy("s").agg(
        F.min(F.struct("d", "m")).alias("first"), *[F.min(c).alias(c) for c in ("f0", "f1", "n", "shared", "odd")]
    )
    nodes = cut(firsts)
    met = cut(_met(marked, nodes))
    near = cut(met.select("s").distinct().join(nodes, "s"))
    texts = whole.select("d", "m", "text").join(
        small(near.select("s", F.col("first.d").alias("d"), F.col("first.m").alias("m"))), ["d", "m"]
    )
    sets = cut(texts.select("s", "text").mapInArrow(lambda b: _sets(b, width), "s long, runs binary").dropDuplicates(["s"]))
    left = sets.select(F.col("s").alias("a"), F.col("runs").alias("left"))
    right = sets.select(F.col("s").alias("b"), F.col("runs").alias("right"))

    def verified(pairs):
        both = small(cut(pairs)).join(left, "a").join(right, "b").select("a", "b", "left", "right")
        return cut(both.mapInArrow(lambda b: _alike(b, similarity), "a long, b long"))

    similar = verified(candidates(near, max_bits, bucket_rows=bucket_rows))
    more = verified(_unconnected(met, near, stars(similar), similarity))
    roots = stars(similar.unionByName(more))
    chosen = (
        nodes.join(roots, nodes["s"] == roots["node"], "left")
        .groupBy(F.coalesce("root", "s").alias("root"))
        .agg(F.min("first").alias("first"))
        .select(F.col("first.d").alias("cd"), F.col("first.m").alias("cm"))
    )
    one = Window.partitionBy("d", "m").orderBy("d")
    return (
        whole.join(chosen, (F.col("d") == F.col("cd")) & (F.col("m") == F.col("cm")))
        .withColumn("n", F.row_number().over(one))
        .where("n = 1")
        .select("row.*")
    )
