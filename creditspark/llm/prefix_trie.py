"""Prefix trie of conversations: for every distinct sequence of first turns, the conversations that start with it.

Turns become 16-byte digests, a conversation the string of its turns' digests. Conversations are
sorted by that string and then by id over all tasks, and each task works through its part in
blocks. In a block, ``lcp[i]`` is the number of turns that row i shares with the row before it; a
sparse table holds the minimum of every stretch of 2^k of them. Every prefix that a row has and
the row before it has not is a candidate, and its two ends are searched independently by halving
steps over the table: the rows that share it lie between. What a node reports are sums over its
rows, so they come from running totals.

A prefix whose rows go on past the ends of a block is open: its pieces, one a block, are summed by
the prefix's digest. Only the lcp of neighbouring tasks (two numbers a task) passes the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditspark.llm.common import cut, small

BLOCK_TURNS = 200_000
CHUNK_IDS = 4_096
_TURN = 16  # bytes of a turn's digest
_NODE, _PIECE, _ENDS = 0, 1, 2
_SCHEMA = (
    "kind int, node binary, parent binary, conv_id long, depth long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends string"
)


def rebuilt(turns: DataFrame, group: int = 100, ways: int = 6) -> DataFrame:
    """(conv_id, turns) of (conv_id, turn, role, text), with first turns that conversations share.

    Each conversation c gets the first h turns of c - c % ``group`` (all if fewer, none without
    such a one), h being crc32(c) % ``ways``, and then its own turns after its first h. Both meet by
    c - c % group, at most ``ways`` - 1 turns being sent to a conversation.
    """
    own = sequences(turns, F.col("conv_id") - F.col("conv_id") % group)
    first = own.where(F.col("conv_id") == F.col("part")).select(F.col("part").alias("of"), F.slice("turns", 1, ways - 1).alias("head"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(ways)).cast("int")
    head = F.coalesce("head", F.array().cast("array<struct<digest:binary,size:int>>"))
    return own.join(first, F.col("part") == F.col("of"), "left").select(
        "conv_id", F.concat(F.slice(head, F.lit(1), h), F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))).alias("turns")
    )


def sequences(turns: DataFrame, part=None) -> DataFrame:
    """(conv_id, part, turns array of (digest, size)) of (conv_id, turn, role, text), in the order of the turns.

    Null turns come first, turns of equal number are ordered by a hash of role and text. Rows
    without a conversation's id belong to none. ``part``: what the rows are dealt by.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        (F.col("conv_id") if part is None else part).cast("long").alias("part"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("digest"),
        F.length(text).alias("size"),
    )
    listed = rows.repartition("part").groupBy("part", "conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "size"))).alias("turns"))
    return listed.select("conv_id", "part", F.transform("turns", lambda x: F.struct(x["digest"].alias("digest"), x["size"].alias("size"))).alias("turns"))


class RangeMinimum:
    """Sparse table: the minimum of any stretch from two overlapping powers of two, and how far a bound holds."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Minimum of values[start:stop], each stretch of one value at least."""
        level = np.frexp(stop - start)[1] - 1
        out = np.empty(len(start), self.levels[0].dtype)
        for k, values in enumerate(self.levels):
            own = level == k
            out[own] = np.minimum(values[start[own]], values[stop[own] - (1 << k)])
        return out

    def right(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The greatest stop with values[at:stop] >= bound."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            values = self.levels[k]
            ok = at < len(values)
            ok[ok] = values[at[ok]] >= bound[ok]
            at[ok] += 1 << k
        return at

    def left(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The least start with values[start:at] >= bound."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            back = at - (1 << k)
            ok = back >= 0
            ok[ok] = self.levels[k][back[ok]] >= bound[ok]
            at[ok] = back[ok]
        return at


def _shared(a: bytes, b: bytes) -> int:
    """Turns that two conversations begin with alike."""
    n = min(len(a), len(b)) // _TURN
    if a[: n * _TURN] == b[: n * _TURN]:
        return n
    lo = 0  # the longest common beginning by halving
    while n - lo > 1:
        mid = (lo + n) // 2
        if a[lo * _TURN : mid * _TURN] == b[lo * _TURN : mid * _TURN]:
            lo = mid
        else:
            n = mid
    return lo


def _prefix_ids(key: bytes, upto: int) -> list[bytes]:
    """Digests that name the prefixes of 0 to ``upto`` turns."""
    h = blake2b(digest_size=16)
    out = [h.digest()]
    for d in range(upto):
        h.update(key[d * _TURN : (d + 1) * _TURN])
        out.append(h.copy().digest())
    return out


def _block(ids: np.ndarray, keys: list[bytes], sizes: list[np.ndarray], before: int, after: int) -> list[pa.RecordBatch]:
    """Rows of ``_SCHEMA`` of sorted conversations; ``before`` and ``after``: turns shared with their neighbours, -1 without one."""
    n = len(ids)
    length = np.array([len(s) for s in sizes], np.int64)
    lcp = np.array([0, *map(_shared, keys, keys[1:])], np.int64)[:n]
    lcp[0] = -1  # the first row names the root and all its prefixes
    known = lcp.copy()
    known[0] = before
    following = np.r_[lcp[1:], after]

    # candidates: prefixes of lcp + 1 to length turns of each row
    new = length - lcp
    at = np.repeat(np.arange(n), new)
    base = np.cumsum(new) - new
    depth = np.arange(len(at)) - base[at] + lcp[at] + 1
    table = RangeMinimum(lcp[1:]) if n > 1 else None
    start = table.left(at, depth) if n > 1 else at
    stop = (table.right(at, depth) if n > 1 else at) + 1

    # running totals over rows
    flat = np.concatenate(sizes) if n else np.zeros(0, np.int64)
    offset = np.cumsum(length) - length
    run = np.r_[0, np.cumsum(flat)]
    whole = run[offset + length] - run[offset]
    shared = np.maximum(known, 0)
    own = whole - (run[offset + shared] - run[offset])  # lengths of the turns that the row has first
    leaf = (following < length).astype(np.int64)
    totals, owned, leaves = (np.r_[0, np.cumsum(x)] for x in (whole, own, leaf))

    above = np.maximum(depth - 1, 0)
    prefix = run[offset[at] + above] - run[offset[at]]  # of the turns above the node's own
    n_convs = stop - start
    all_turns = totals[stop] - totals[start] - n_convs * prefix
    first_own = whole[start] - (run[offset[start] + np.maximum(shared[start], above)] - run[offset[start]])
    once = owned[stop] - owned[start + 1] + first_own
    saved = all_turns - once
    n_leaves = leaves[stop] - leaves[start]
    least = RangeMinimum(ids).least(start, stop)

    # a candidate's parent: the one before it in its row, or where the left end of the shorter prefix lies
    parent = np.arange(len(at)) - 1
    head = base[new > 0]
    head = head[head > 0]
    if len(head):
        up = depth[head] - 1
        left = table.left(at[head], up)
        parent[head] = base[left] + up - lcp[left] - 1
    first_seen = (depth > known[at]) & (depth > 0)
    n_children = np.bincount(parent[first_seen], minlength=len(at))

    open_ = ((start == 0) & (depth <= before)) | ((stop == n) & (depth <= after)) | (depth == 0)
    named: dict[int, bytes] = {}
    for row, shared_turns in ((0, max(before, 0)), (n - 1, max(after, 0))):
        names = _prefix_ids(keys[row], min(shared_turns, int(length[row])))
        left = table.left(np.full(len(names), row), np.arange(len(names))) if n > 1 else np.zeros(len(names), int)
        for d, (at_row, name) in enumerate(zip(left, names)):
            named[int(base[at_row] + d - lcp[at_row] - 1)] = name

    # conversations that end at a node: the rows from its first on that have no more turns
    same = np.r_[False, (lcp[1:] == length[1:]) & (length[1:] == length[:-1])]
    runs = np.r_[np.flatnonzero(~same), n]
    run_stop = runs[np.searchsorted(runs, np.arange(n), "right")]
    ending = length[start] == depth
    empty = sha256(b"").hexdigest()

    node, up, ends, parent_id = [None] * len(at), [None] * len(at), [empty] * len(at), [None] * len(at)
    chunks = []
    for c in np.flatnonzero(ending).tolist():
        lo, hi = int(start[c]), int(run_stop[start[c]])
        if open_[c]:
            for k in range(lo, hi, CHUNK_IDS):
                part = ids[k : min(k + CHUNK_IDS, hi)].tolist()
                chunks.append((named[c], part[0], ",".join(map(str, part))))
        else:
            h = sha256()
            for k in range(lo, hi, CHUNK_IDS):
                h.update((("," if k > lo else "") + ",".join(map(str, ids[k : min(k + CHUNK_IDS, hi)].tolist()))).encode())
            ends[c] = h.hexdigest()
    for c, name in named.items():
        node[c] = name
        ends[c] = None
    below = np.flatnonzero(open_[parent] & (depth > 0)).tolist()
    for c in below:
        up[c] = named[int(parent[c])]
    inner = (~open_[parent]) & (depth > 0)
    parent_values = pa.array(np.where(inner, least[parent], 0), mask=~inner)
    out = []
    columns = [
        pa.array(np.where(open_, _PIECE, _NODE).astype(np.int32)), pa.array(node, pa.binary()), pa.array(up, pa.binary()), pa.array(least),
        pa.array(depth), parent_values, *[pa.array(x.astype(np.int64)) for x in (n_convs, n_children, n_leaves, saved)], pa.array(ends, pa.string()),
    ]
    names = [f.split()[0] for f in _SCHEMA.split(", ")]
    every = pa.RecordBatch.from_arrays(columns, names)
    out += [every.slice(k, 50_000) for k in range(0, every.num_rows, 50_000)]
    for k in range(0, len(chunks), 64):
        part = chunks[k : k + 64]
        none = [None] * len(part)
        out.append(
            pa.RecordBatch.from_arrays(
                [
                    pa.array([_ENDS] * len(part), pa.int32()), pa.array([x[0] for x in part], pa.binary()), pa.array(none, pa.binary()),
                    pa.array([x[1] for x in part], pa.int64()), *[pa.array(none, pa.int64()) for _ in range(6)], pa.array([x[2] for x in part], pa.string()),
                ],
                names,
            )
        )
    return out


def _blocks(rows: Iterator[tuple[int, bytes, np.ndarray]], before: int, after: int, block_turns: int) -> Iterator[pa.RecordBatch]:
    """Blocks of about ``block_turns`` turns of a task's sorted rows."""
    ids: list[int] = []
    keys: list[bytes] = []
    sizes: list[np.ndarray] = []
    turns = 0
    for i, key, own in rows:
        if turns >= block_turns:
            shared = _shared(keys[-1], key)
            yield from _block(np.array(ids, np.int64), keys, sizes, before, shared)
            before, turns = shared, 0
            ids, keys, sizes = [], [], []
        ids.append(i)
        keys.append(key)
        sizes.append(own)
        turns += len(own) + 1
    if ids:
        yield from _block(np.array(ids, np.int64), keys, sizes, before, after)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes, np.ndarray]]:
    for batch in batches:
        values, ends = batch.column("sizes").values.to_numpy(), batch.column("sizes").offsets.to_numpy()
        for i, key, lo, hi in zip(batch.column("conv_id").to_pylist(), batch.column("key").to_pylist(), ends, ends[1:]):
            yield i, key, values[lo:hi].astype(np.int64)


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, first, last): the first and last conversation of each task."""
    part = first = last = None
    for batch in batches:
        if batch.num_rows:
            part = batch.column("part")[0].as_py()
            keys = batch.column("key")
            first = keys[0].as_py() if first is None else first
            last = keys[batch.num_rows - 1].as_py()
    if part is not None:
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([first], pa.binary()), pa.array([last], pa.binary())], ["part", "first", "last"])


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, shared): turns that a task's first conversation shares with the one before it."""
    last = None
    for batch in batches:
        parts, out = [], []
        for part, first, end in zip(*(c.to_pylist() for c in batch.columns)):
            parts.append(part)
            out.append(-1 if last is None else _shared(last, first))
            last = end
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(out, pa.int64())], ["part", "shared"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, ends): SHA-256 of each node's ids, from rows sorted by node and first id."""
    node, h = None, None
    for batch in batches:
        out = []
        for own, text in zip(*(c.to_pylist() for c in batch.columns)):
            if own != node:
                if node is not None:
                    out.append((node, h.hexdigest()))
                node, h = own, sha256(text.encode())
            else:
                h.update(f",{text}".encode())
        yield _ended(out)
    if node is not None:
        yield _ended([(node, h.hexdigest())])


def _ended(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([n for n, _ in rows], pa.binary()), pa.array([t for _, t in rows], pa.string())], ["node", "digest"])


def prefix_trie(convs: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row for each distinct sequence of first turns of ``convs`` (conv_id, turns array of (digest, size)), ids distinct.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): the
    smallest member and that of the parent, members, children, childless nodes of the subtree,
    (n_convs - 1) x size of the last turn summed over the subtree, and the SHA-256 of the ids of the
    members that end here, rising, joined by commas. The root (depth 0) has no parent. A
    conversation without turns ends at the root. No conversations give no rows.
    """
    spark: SparkSession = convs.sparkSession
    digests = F.transform("turns", lambda x: x["digest"])
    # joined as hexadecimal text, as there is no sum of binaries over an array
    key = F.unhex(F.array_join(F.transform(digests, lambda x: F.hex(x)), ""))
    keyed = convs.select("conv_id", key.alias("key"), F.transform("turns", lambda x: x["size"]).alias("sizes"))
    ordered = cut(keyed.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id"))
    parts = ordered.select(F.spark_partition_id().alias("part"), "conv_id", "key", "sizes")
    edges = parts.select("part", "key").mapInArrow(_edges, "part int, first binary, last binary")
    met = {r.part: r.shared for r in edges.repartition(1).sortWithinPartitions("part").mapInArrow(_meeting, "part int, shared long").collect()}
    following = {}
    last = None
    for part in sorted(met):
        if last is not None:
            following[last] = met[part]
        last = part

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        part = first.column("part")[0].as_py()

        def every():
            yield first
            yield from batches

        yield from _blocks(_rows(every()), met[part], following.get(part, -1), block_turns)

    found = cut(parts.mapInArrow(run, _SCHEMA))
    sums = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    pieces = (
        found.where(F.col("kind") == _PIECE)
        .groupBy("node")
        .agg(F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"), *[F.sum(c).alias(c) for c in sums])
    )
    chunks = found.where(F.col("kind") == _ENDS).select("node", "conv_id", "ends").repartition("node").sortWithinPartitions("node", "conv_id")
    hashed = chunks.select("node", "ends").mapInArrow(_digests, "node binary, digest string").withColumnRenamed("node", "hn")
    opened = cut(
        pieces.join(hashed, F.col("node") == F.col("hn"), "left").select(
            "node", "parent", "conv_id", "depth", *sums, F.coalesce("digest", F.lit(sha256(b"").hexdigest())).alias("ends_sha256")
        )
    )
    above = small(opened.select(F.col("node").alias("pn"), F.col("conv_id").alias("above")))
    closed = found.where(F.col("kind") == _NODE).select("parent", "conv_id", "depth", "parent_conv_id", *sums, F.col("ends").alias("ends_sha256"))
    rest = opened.select("parent", "conv_id", "depth", F.lit(None).cast("long").alias("parent_conv_id"), *sums, "ends_sha256")
    below = closed.where("parent is not null").unionByName(rest).join(above, F.col("parent") == F.col("pn"), "left")
    columns = ["conv_id", "depth", "parent_conv_id", *sums, "ends_sha256"]
    return closed.where("parent is null").select(*columns).unionByName(below.drop("parent_conv_id").withColumnRenamed("above", "parent_conv_id").select(*columns))
