"""Repeated passages across documents, found by shared lines and removed by pairwise alignment.

Every shortest run of lines that reaches ``MIN_WORDS`` words, taken from each line onwards and
from each line backwards, names the first document that holds it; every later holder is paired
with that one. Any passage of ``MIN_WORDS`` words that a document shares with an earlier one is
covered by such runs, so no line of it is missed, and a document has at most two pairs a line,
however many documents share it. Each pair is aligned by patience diff over the lines both hold;
runs of lines in another order, or repeated, are then matched wherever they stand. Blocks of
lines that follow each other in both documents, ``MIN_WORDS`` words or more, are deleted from the
later one. The first holder of a line never loses it.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditspark.llm.common import cut
from creditspark.llm.quality import let

MIN_WORDS = 30
_BLANK = " \t\n\x0b\x0c\r"
_WIDTH = 5  # numbers a line is sent as: index among lines with words, place among all, two hashes, words


def _increasing(places: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence (patience sorting)."""
    tops: list[int] = []
    heads: list[int] = []
    back = [-1] * len(places)
    for i, place in enumerate(places):
        pile = bisect_left(tops, place)
        back[i] = heads[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(place)
            heads.append(i)
        else:
            tops[pile], heads[pile] = place, i
    out, i = [], heads[-1] if heads else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned pairs (i, j) with a[i] == b[j], rising in both.

    Equal ends first; then lines that occur once on either side, in their longest common order,
    divide the rest. Where no line does, the k-th occurrence stands for the line.
    """
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            pairs.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        left, right = a[i:i_end], b[j:j_end]
        many, more = Counter(left), Counter(right)
        if not any(many[x] == 1 == more.get(x) for x in many):
            left, right = _numbered(left), _numbered(right)
            many, more = Counter(left), Counter(right)
        where = {x: k for k, x in enumerate(right) if more[x] == 1}
        common = [(k, where[x]) for k, x in enumerate(left) if many[x] == 1 and x in where]
        chosen = [common[k] for k in _increasing([y for _, y in common])]
        if not chosen:
            continue
        pairs.extend((i + x, j + y) for x, y in chosen)
        at_i, at_j = i, j
        for x, y in [*chosen, (i_end - i, j_end - j)]:
            if at_i < i + x and at_j < j + y:
                todo.append((at_i, i + x, at_j, j + y))
            at_i, at_j = i + x + 1, j + y + 1
    return sorted(pairs)


def _numbered(lines: list) -> list:
    seen: Counter = Counter()
    out = []
    for x in lines:
        out.append((x, seen[x]))
        seen[x] += 1
    return out


def common_blocks(later: list, earlier: list, min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """Places [start, end) in the later document of the aligned blocks of at least ``min_words`` words.

    Lines are (index, place, hash, words): a block's lines follow each other by index in both.
    """
    blocks, run = [], []
    for i, j in [*patience([x[2] for x in later], [x[2] for x in earlier]), (None, None)]:
        follows = run and i is not None and later[i][0] == later[run[-1][0]][0] + 1 and earlier[j][0] == earlier[run[-1][1]][0] + 1
        if run and not follows:
            if sum(later[k][3] for k, _ in run) >= min_words:
                blocks.append((run[0][0], run[-1][0] + 1))
            run = []
        run.append((i, j))
    if sum(stop - start for start, stop in blocks) < len(later):
        blocks += _runs(later, earlier, min_words)
    return sorted({(later[start][1], later[stop - 1][1] + 1) for start, stop in blocks})


def _runs(later: list, earlier: list, min_words: int) -> list[tuple[int, int]]:
    """Per line of ``later`` the longest run [start, stop) that ends there and stands anywhere in ``earlier``, if long enough.

    A suffix automaton of ``earlier``; a gap in the indices is a line of its own there and ends a run here.
    """
    steps: list[dict] = [{}]
    link, size = [-1], [0]
    last = 0
    for k, x in enumerate(earlier):
        for line in ([("gap", k), x[2]] if k and x[0] != earlier[k - 1][0] + 1 else [x[2]]):
            new, p = len(steps), last
            steps.append({})
            link.append(0)
            size.append(size[last] + 1)
            while p >= 0 and line not in steps[p]:
                steps[p][line] = new
                p = link[p]
            if p >= 0:
                q = steps[p][line]
                if size[q] == size[p] + 1:
                    link[new] = q
                else:
                    twin = len(steps)
                    steps.append(dict(steps[q]))
                    link.append(link[q])
                    size.append(size[p] + 1)
                    while p >= 0 and steps[p].get(line) == q:
                        steps[p][line] = twin
                        p = link[p]
                    link[q] = link[new] = twin
            last = new
    words = [0]
    for x in later:
        words.append(words[-1] + x[3])
    found, state, length = [], 0, 0
    for k, x in enumerate(later):
        if k and x[0] != later[k - 1][0] + 1:
            state = length = 0
        while state and x[2] not in steps[state]:
            state = link[state]
            length = size[state]
        if x[2] in steps[state]:
            state, length = steps[state][x[2]], length + 1
        if length and words[k + 1] - words[k + 1 - length] >= min_words:
            found.append((k + 1 - length, k + 1))
    return found


def _rows_of_numbers(column: pa.ListArray) -> Iterator[np.ndarray]:
    """Each row's lines as a matrix, without making Python numbers of them."""
    values, ends = column.values.to_numpy(), column.offsets.to_numpy()
    for start, end in zip(ends, ends[1:]):
        yield values[start:end].reshape(-1, _WIDTH)


def _common(lines: np.ndarray, other: np.ndarray) -> list[tuple]:
    """Lines whose first hash the other document has too, as (index, place, hashes, words)."""
    return [(i, p, (h1, h2), w) for i, p, h1, h2, w in lines[np.isin(lines[:, 2], other[:, 2])].tolist()]


def _aligned(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        ids, marks = (c.to_numpy() for c in batch.columns[:2])
        for d, mark, later, earlier in zip(ids, marks, *map(_rows_of_numbers, batch.columns[2:])):
            out += [(d, mark, *b) for b in common_blocks(_common(later, earlier), _common(earlier, later), min_words)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["d", "m", "start", "stop"])


def _window_keys(lines: np.ndarray, min_words: int) -> np.ndarray:
    """Two hashes of every shortest run of lines that reaches ``min_words`` words, from a line onwards or backwards."""
    n = len(lines)
    place = np.arange(n)
    run = np.cumsum(np.r_[True, np.diff(lines[:, 0]) != 1][:n])  # lines of one run follow each other
    words = np.r_[0, np.cumsum(lines[:, 4])]
    stop = np.searchsorted(words, words[:-1] + min_words)  # lines [k, stop) have the words
    start = np.searchsorted(words, words[1:] - min_words, "right") - 1  # and so have [start, k + 1)
    ahead = (stop <= n) & (run == run[np.minimum(stop, n) - 1])
    back = (start >= 0) & (run == run[np.maximum(start, 0)])
    starts, stops = np.r_[place[ahead], start[back]], np.r_[stop[ahead], place[back] + 1]
    keys = []
    for column, base in ((2, 0x9E3779B97F4A7C15), (3, 0xC2B2AE3D27D4EB4F)):
        power = np.cumprod(np.r_[np.uint64(1), np.full(n, base, np.uint64)])
        inverse = np.cumprod(np.r_[np.uint64(1), np.full(n, pow(base, -1, 1 << 64), np.uint64)])
        sums = np.r_[np.uint64(0), np.cumsum(lines[:, column].astype(np.uint64) * power[:n])]
        keys.append(((sums[stops] - sums[starts]) * inverse[starts] + (stops - starts).astype(np.uint64)).view(np.int64))
    return np.unique(np.stack(keys, axis=1), axis=0)


def _windows(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """(d, m, h1, h2) of the runs of lines of each document."""
    for batch in batches:
        keys = [_window_keys(lines, min_words) for lines in _rows_of_numbers(batch.column(2))]
        sizes = [len(k) for k in keys]
        if sum(sizes):
            both = np.concatenate(keys)
            own = [np.repeat(c.to_numpy(), sizes) for c in batch.columns[:2]]
            for k in range(0, len(both), 200_000):
                part = slice(k, k + 200_000)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x[part])) for x in (*own, both[:, 0], both[:, 1])], ["d", "m", "h1", "h2"])


def _identity(id_col: str, text_col: str) -> list[Column]:
    """What tells documents apart and orders them: the id (null last) and a hash of the text."""
    return [F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("d"), F.xxhash64(F.col(text_col)).alias("m")]


def repeated_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(d, m, ranges): for documents that lose lines, the places [start, stop) of their lines to delete, in order."""
    lines = F.transform(F.split(F.col(text_col), "\n"), lambda x, i: F.struct(i.alias("place"), F.btrim(x, F.lit(_BLANK)).alias("line")))
    line = F.col("x.line")
    rows = docs.select(
        *_identity(id_col, text_col), F.posexplode(F.filter(lines, lambda x: x["line"] != "")).alias("i", "x")
    ).select(
        "d",
        "m",
        F.col("i").cast("long").alias("i"),
        F.col("x.place").cast("long").alias("place"),
        F.xxhash64(line).alias("h1"),
        F.xxhash64(F.lit(7), line).alias("h2"),
        F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("w"),
    )
    own = F.struct("d", "m")
    # Computed first, so that the join below has two plain sides and a line that a third of all rows hold can be split.
    held = cut(rows.groupBy("h1", "h2").agg(F.min(own).alias("first"), F.max(own).alias("last")).where("first <> last"))
    shared = (
        rows.join(held.select(F.col("h1").alias("k1"), F.col("h2").alias("k2")), (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")))
        .groupBy("d", "m")
        .agg(F.sort_array(F.collect_set(F.struct("i", "place", "h1", "h2", "w"))).alias("lines"))
    )
    kept = cut(shared)
    numbers = F.flatten(F.transform("lines", lambda x: F.array(x["i"], x["place"], x["h1"], x["h2"], x["w"])))
    sent = kept.select("d", "m", numbers.alias("numbers"))
    # computed first, as above: both sides of the join are plain
    runs = cut(sent.mapInArrow(lambda batches: _windows(batches, min_words), "d long, m long, h1 long, h2 long"))
    starts = cut(runs.groupBy("h1", "h2").agg(F.min(own).alias("first"), F.max(own).alias("last")).where("first <> last"))
    named = runs.join(starts, ["h1", "h2"]).where("first <> struct(d, m)")
    pairs = named.select("d", "m", F.col("first.d").alias("fd"), F.col("first.m").alias("fm")).distinct()
    earlier = sent.select(F.col("d").alias("fd"), F.col("m").alias("fm"), F.col("numbers").alias("earlier"))
    both = pairs.join(sent.withColumnRenamed("numbers", "later"), ["d", "m"]).join(earlier, ["fd", "fm"])
    found = both.select("d", "m", "later", "earlier").mapInArrow(
        lambda batches: _aligned(batches, min_words), "d long, m long, start long, stop long"
    )
    return found.groupBy("d", "m").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("found")).select(
        "d", "m", _merged(F.col("found")).alias("ranges")
    )


def _merged(found: Column) -> Column:
    """Ranges that touch or overlap made one."""

    def add(out: Column, x: Column) -> Column:
        top = F.get(out, F.size(out) - 1)
        joined = F.struct(top["start"].alias("start"), F.greatest(top["stop"], x["stop"]).alias("stop"))
        grown = F.concat(F.slice(out, F.lit(1), F.greatest(F.size(out) - 1, F.lit(0))), F.array(joined))
        return F.when(F.size(out) == 0, F.array(x)).when(top["stop"] >= x["start"], grown).otherwise(F.concat(out, F.array(x)))

    return F.aggregate(found, F.array().cast("array<struct<start:bigint,stop:bigint>>"), add)


def _without(text: Column, ranges: Column) -> Column:
    """A text without the lines in ``ranges``."""

    def rest(lines: Column) -> Column:
        def stretch(k: Column) -> Column:
            start = F.when(k == 0, F.lit(0).cast("long")).otherwise(F.get(ranges, k - 1)["stop"])
            stop = F.coalesce(F.get(ranges, k)["start"], F.size(lines).cast("long"))
            return F.slice(lines, (start + 1).cast("int"), (stop - start).cast("int"))

        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(ranges)), stretch)), "\n")

    return F.when(ranges.isNull(), text).otherwise(let(F.split(text, "\n"), rest))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, report: bool = False
) -> DataFrame:
    """``docs`` with the text of later documents freed of blocks that earlier ones hold; one row per input row.

    Documents are ordered by id, nulls last, then by a hash of the text. Rows equal in both are
    the same document and are treated alike. Lines are compared without blanks at their ends;
    lines without a word count as part of the block around them. A null or empty text stays as
    it is, a text that is all repeats becomes empty. ``report``: columns (doc_id, text, n_lines,
    n_removed, removed) instead, removed being the places [start, stop) of lines deleted. No rows
    give no rows.
    """
    gone = repeated_blocks(docs, id_col, text_col, min_words)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*columns).alias("row"), *_identity(id_col, text_col))
    gone = gone.select(F.col("d").alias("gd"), F.col("m").alias("gm"), "ranges")
    both = rows.join(gone, (F.col("d") == F.col("gd")) & (F.col("m") == F.col("gm")), "left")
    text = _without(F.col("row")[text_col], F.col("ranges"))
    if not report:
        return both.select(*[(text if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])
    ranges = F.coalesce(F.col("ranges"), F.array().cast("array<struct<start:bigint,stop:bigint>>"))
    return both.select(
        F.col("row")[id_col].alias("doc_id"),
        text.alias("text"),
        F.size(F.split(F.coalesce(F.col("row")[text_col], F.lit("")), "\n")).cast("long").alias("n_lines"),
        F.aggregate(ranges, F.lit(0).cast("long"), lambda a, x: a + x["stop"] - x["start"]).alias("n_removed"),
        ranges.alias("removed"),
    )
