"""Spelling variants grouped: each word points to the frequent word one edit away, and to the end of that chain.

Words one edit apart differ by one letter too many, one too few, or both. Words are arranged in a
trie by the counts of successive letter groups (letters of equal code point modulo ``LEVELS``);
a depth-first search spends a surplus and a deficit of at most one each along the path, many
words at a time, and the words of the leaves it reaches are verified letter by letter where they
share their first or last half, as words one edit apart must.

The trie is dealt by its top: the counts of ``TOPS`` coarser groups name a subtree, and a word is
sent to each subtree that the budget reaches. The longer word of two visits the shorter, and of
two of equal length the one whose counts come first visits the other, so a pair is found once.
A subtree of more than ``CROWDED`` words is dealt by the counts of all ``LEVELS`` groups, and a
leaf of so many by those and the halves of its words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditspark.llm.common import cut, rows_of

MIN_LETTERS = 6
MIN_COUNT = 5
RATIO = 5
SLIP = 199
TOPS, LEVELS = 4, 12  # the finer groups refine the coarser, as 4 divides 12
CROWDED = 20_000
_MEMBER, _AT_HOME = 2, 1  # visits of a word: as a word of the trie, in its own subtree; else the change of length
_LAST = 100  # added to the visits of a leaf dealt by last halves
_FLUSH = 400_000
_LONG = 4_000_000  # letters of a text from which its runs are taken in parts
_MATRIX = 4_000_000  # comparisons of halves made at a time


def _runs(text: str, run: re.Pattern) -> Counter:
    """Occurrences of the runs of letters of a text, A-Z in lower case."""
    lower = text.encode().lower().decode()  # bytes.lower() leaves all but A-Z
    if len(lower) < _LONG:
        return Counter(run.findall(lower))
    out: Counter = Counter()
    found = run.finditer(lower)
    while part := [m[0] for m in islice(found, 1_000_000)]:
        out.update(part)
    return out


def _words(batches: Iterator[pa.RecordBatch], min_letters: int, slip: int) -> Iterator[pa.RecordBatch]:
    """(word, n) of (doc_id, text), given out whenever the table has grown to ``_FLUSH`` words."""
    every: Counter = Counter()
    run = re.compile("[A-Za-zÀ-ÿ]{%d,}" % max(min_letters, 1))  # shorter runs do not grow by losing a letter

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(every), pa.string()), pa.array(every.values(), pa.int64())], ["word", "n"])

    for ids, texts in rows_of(batches):
        for doc_id, text in zip(ids, texts):
            start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for word, n in _runs(text or "", run).items():
                if slip:
                    h = crc32(word.encode(), start)
                    if h % slip == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < min_letters:
                            continue
                every[word] += n
            if len(every) >= _FLUSH:
                yield out()
                every.clear()
    if every:
        yield out()


def word_counts(docs: DataFrame, id_col: str, text_col: str, min_letters: int, min_count: int, slip: int) -> DataFrame:
    """(word, n): words of at least ``min_letters`` letters that occur ``min_count`` times in all texts."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counted = rows.mapInArrow(lambda batches: _words(batches, min_letters, slip), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


class Spelled:
    """Words as numbers: the counts of their letter groups, and hashes of their first and last letters."""

    def __init__(self, words: list[str]):
        letters = np.frombuffer(("\n".join(words) + "\n").encode("utf-32-le"), np.uint32).astype(np.uint64)
        end = letters == 10
        self.stop = np.flatnonzero(end)
        self.start = np.r_[0, self.stop[:-1] + 1]
        self.length = self.stop - self.start
        word = (np.cumsum(end) - end)[~end]
        self.counts = np.bincount(word * LEVELS + (letters[~end] % np.uint64(LEVELS)).astype(np.int64), minlength=len(words) * LEVELS).reshape(-1, LEVELS)
        self.tops = np.stack([self.counts[:, g::TOPS].sum(axis=1) for g in range(TOPS)], axis=1)
        base = 0x9E3779B97F4A7C15
        powers = np.cumprod(np.r_[np.uint64(1), np.full(len(letters), base, np.uint64)])
        self._back = np.cumprod(np.r_[np.uint64(1), np.full(len(letters), pow(base, -1, 1 << 64), np.uint64)])
        self._sums = np.r_[np.uint64(0), np.cumsum(letters * powers[:-1])]

    def halves(self, shorter: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the first and of the last letters: half of the word's less ``shorter``."""
        k = (self.length - shorter) // 2
        first = (self._sums[self.start + k] - self._sums[self.start]) * self._back[self.start]
        last = (self._sums[self.stop] - self._sums[self.stop - k]) * self._back[self.stop - k]
        return first, last


def _hashed(counts: np.ndarray) -> np.ndarray:
    """A number for each row of counts."""
    with np.errstate(over="ignore"):
        x = np.full(len(counts), counts.shape[1], np.uint64)
        for column in counts.T:
            x = (x ^ column.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(29)
        return x.view(np.int64)


def _leaf_keys(keys: np.ndarray, side: int, halves: np.ndarray) -> np.ndarray:
    return _hashed(np.stack([keys.view(np.uint64), np.full(len(keys), side, np.uint64), halves], axis=1))


def _moves(groups: int):
    """(group with one letter less or None, group with one more or None, change of length)."""
    yield None, None, 0
    for less in range(groups):
        yield less, None, -1
        for more in range(groups):
            if more != less:
                yield less, more, 0


def _moved(counts: np.ndarray, less: int | None, more: int | None) -> np.ndarray:
    out = counts.copy()
    if less is not None:
        out[:, less] -= 1
    if more is not None:
        out[:, more] += 1
    return out


_TOP_MOVES = [m for m in _moves(TOPS) if m[1] is None or m[1] < m[0]]  # of equal length: to counts from its own onwards


def _places(words: list[str], crowded: np.ndarray, full: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(key, visit, place of the word) of all rows that ``words`` are dealt as."""
    s = Spelled(words)
    every = np.arange(len(words))
    own, leaf = _hashed(s.tops), _hashed(s.counts)

    def leaves(at: np.ndarray, keys: np.ndarray, visit: int):
        """Rows dealt by all groups: crowded leaves by the halves of their words."""
        split = np.isin(keys, full)
        yield keys[~split], np.full((~split).sum(), visit), at[~split]
        if split.any():
            halves = s.halves(1 if visit == -1 else 0)
            for side in (0, 1):
                yield _leaf_keys(keys[split], side, halves[side][at[split]]), np.full(split.sum(), visit + side * _LAST), at[split]

    deep = np.isin(own, crowded)
    yield own[~deep], np.full((~deep).sum(), _MEMBER), every[~deep]
    yield from leaves(every[deep], leaf[deep], _MEMBER)
    for less, more, change in _TOP_MOVES:
        at = every if less is None else np.flatnonzero(s.tops[:, less] > 0)
        keys = _hashed(_moved(s.tops[at], less, more))
        deep = np.isin(keys, crowded)
        yield keys[~deep], np.full((~deep).sum(), _AT_HOME if less is None else change), at[~deep]
        if not deep.any():
            continue
        for finer_less, finer_more, finer_change in _moves(LEVELS):
            if finer_change != change:
                continue
            if less is None:
                if finer_less is not None and (finer_less % TOPS != finer_more % TOPS or finer_more > finer_less):
                    continue
            elif finer_less is None or finer_less % TOPS != less or (more is not None and finer_more % TOPS != more):
                continue
            some = at[deep] if finer_less is None else at[deep][s.counts[at[deep], finer_less] > 0]
            home = less is None and finer_less is None
            yield from leaves(some, _hashed(_moved(s.counts[some], finer_less, finer_more)), _AT_HOME if home else change)


def _dealt(batches: Iterator[pa.RecordBatch], crowded: np.ndarray, full: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(key, visit, word, n): each word once for its own place in the trie and once for each visit."""
    for batch in batches:
        for start in range(0, batch.num_rows, 4096):
            part = batch.slice(start, 4096)
            for keys, visits, at in _places(part.column(0).to_pylist(), crowded, full):
                if len(at):
                    columns = [pa.array(keys), pa.array(visits.astype(np.int32)), *[c.take(pa.array(at)) for c in part.columns]]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "visit", "word", "n"])


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced letter makes ``a`` ``b``."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) < len(b):
        a, b = b, a
    at = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    return a[at + 1 :] == (b[at:] if len(a) > len(b) else b[at + 1 :])


class Trie:
    """Words sorted by the counts of their letter groups, so that a node of a level is a stretch of them."""

    def __init__(self, words: list[str]):
        spelled = Spelled(words)
        order = np.lexsort(spelled.counts.T[::-1])
        self.words = [words[k] for k in order]
        self.order, self.counts = order, spelled.counts[order]
        self.first, self.last = (h[order] for h in spelled.halves())

    def near(self, words: list[str], changes: np.ndarray, by_last: bool = False) -> Iterator[tuple[int, int]]:
        """(place in ``words``, place among the members): one edit apart, with ``changes`` (0 or -1) letters more.

        A path may have one letter less than the word, and one more where the lengths are equal;
        a path that spends more is left. ``by_last``: pairs that share their first half are not given.
        """
        asked = Spelled(words)
        first, last = asked.halves(-changes)
        todo = [(0, 0, len(self.words), np.arange(len(words)), np.ones(len(words), np.int8), (1 + changes).astype(np.int8))]
        while todo:
            level, lo, hi, who, deficit, surplus = todo.pop()
            if (self.counts[lo, level:] == self.counts[hi - 1, level:]).all():  # one leaf below
                gap = asked.counts[who, level:] - self.counts[lo, level:]
                kept = who[(np.maximum(gap, 0).sum(axis=1) <= deficit) & (np.maximum(-gap, 0).sum(axis=1) <= surplus)]
                yield from self._verified(lo, hi, words, kept, first, last, by_last)
                continue
            column = self.counts[lo:hi, level]
            starts = np.r_[0, np.flatnonzero(column[1:] != column[:-1]) + 1, hi - lo]
            own = asked.counts[who, level]
            for start, stop in zip(starts, starts[1:]):
                gap = own - column[start]
                ok = (gap == 0) | ((gap == 1) & (deficit > 0)) | ((gap == -1) & (surplus > 0))
                if ok.any():
                    gap = gap[ok]
                    todo.append((level + 1, lo + start, lo + stop, who[ok], deficit[ok] - (gap == 1), surplus[ok] - (gap == -1)))

    def _verified(self, lo, hi, words, who, first, last, by_last) -> Iterator[tuple[int, int]]:
        step = max(1, _MATRIX // (hi - lo))
        for start in range(0, len(who), step):
            part = who[start : start + step]
            same_first = first[part][:, None] == self.first[lo:hi]
            same_last = last[part][:, None] == self.last[lo:hi]
            for i, j in zip(*np.nonzero(same_last & ~same_first if by_last else same_first | same_last)):
                if one_edit(words[part[i]], self.words[lo + j]):
                    yield int(part[i]), int(self.order[lo + j])


def _group(words: list[str], visits: np.ndarray, counts: np.ndarray) -> Iterator[tuple[str, str, int, int]]:
    """(word, near, n, near_n) of the rows of one key, a pair once."""
    by_last = bool(len(visits)) and visits.max() >= _LAST - 1
    visits = visits - _LAST if by_last else visits
    members, guests = np.flatnonzero(visits == _MEMBER), np.flatnonzero(visits != _MEMBER)
    if not len(members) or not len(guests):
        return
    own, asking = [words[k] for k in members], [words[k] for k in guests]
    for i, j in Trie(own).near(asking, np.minimum(visits[guests], 0), by_last):
        if visits[guests[i]] != _AT_HOME or asking[i] < own[j]:
            yield asking[i], own[j], int(counts[guests[i]]), int(counts[members[j]])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, near, near_n), both ways, from rows sorted by key."""
    held: list[pa.RecordBatch] = []
    rows: list[tuple[str, str, int]] = []

    def groups(table: pa.Table, last: bool):
        """The pairs of all keys of ``table``, but for its last unless nothing follows; what is left."""
        keys = table.column("key").to_numpy()
        starts = np.r_[0, np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)]
        stop = starts[-1] if last else starts[-2]
        words, visits, counts = (table.column(c).slice(0, stop) for c in ("word", "visit", "n"))
        visits, counts, words = visits.to_numpy(), counts.to_numpy(), words.to_pylist()
        for lo, hi in zip(starts, starts[1:]):
            if hi <= stop:
                for a, b, n_a, n_b in _group(words[lo:hi], visits[lo:hi], counts[lo:hi]):
                    rows.append((a, b, n_b))
                    rows.append((b, a, n_a))
        return table.slice(stop)

    def out():
        while rows:
            part, rows[:] = rows[:100_000], rows[100_000:]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in part], pa.string()), pa.array([r[1] for r in part], pa.string()), pa.array([r[2] for r in part], pa.int64())],
                ["word", "near", "near_n"],
            )

    waiting, size = 0, 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            waiting += batch.num_rows
        if waiting >= max(100_000, 2 * size):  # a key of more rows is waited for, each time twice as long
            table = groups(pa.Table.from_batches(held), False)
            held, waiting = table.to_batches(), table.num_rows
            size = waiting
            yield from out()
    if held:
        groups(pa.Table.from_batches(held), True)
        yield from out()


def near_words(words: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(word, near, near_n): each ordered pair of ``words`` (word, n), computed and distinct, one edit apart.

    The names of crowded subtrees and leaves reach the driver: one for every ``crowded`` words at most.
    """

    def keys(of: str, within: np.ndarray | None = None) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for (own,) in rows_of(batches, 8192):
                s = Spelled(own)
                all_keys = _hashed(getattr(s, of))
                if within is not None:
                    all_keys = all_keys[np.isin(_hashed(s.tops), within)]
                found, n = np.unique(all_keys, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n.astype(np.int64))], ["key", "n"])

        sizes = words.select("word").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        return np.array(sorted(r.key for r in sizes.where(F.col("n") > crowded).select("key").collect()), np.int64)

    tops = keys("tops")
    full = keys("counts", tops) if len(tops) else tops
    dealt = words.select("word", "n").mapInArrow(lambda batches: _dealt(batches, tops, full), "key long, visit int, word string, n long")
    return dealt.repartition("key").sortWithinPartitions("key").mapInArrow(_pairs, "word string, near string, near_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the end of each chain, by doubling.

    A form occurs at least ``ratio`` > 1 times as often as its word, so chains end and are as
    long as the logarithm of the largest count; the rounds are its logarithm again.
    """
    ends = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        step = ends.select(F.col("word").alias("at"), F.col("root").alias("next"))
        moved = cut(ends.join(step, F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        ends = moved.select("word", "root")
        if moved.where("moved").limit(1).count() == 0:
            return ends


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    slip: int = SLIP,
    crowded: int = CROWDED,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n): one row for each word of ``min_letters`` that occurs ``min_count`` times.

    ``form`` is the near word that occurs most often (ties: the smallest), if ``ratio`` times as
    often as the word; ``root`` the last of the chain of forms. ``slip``: a run whose hash with its
    document's id it divides loses a letter first (0: none does). Null and empty texts have no
    words; a null id is hashed as an empty one. Repeated rows count each time; words of any length
    are taken whole. Other columns play no part. No rows give no rows.
    """
    words = cut(word_counts(docs, id_col, text_col, min_letters, min_count, slip))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    found = near_words(words, crowded).groupBy("word").agg(best.alias("best"), F.count("*").alias("n_near"))
    best_n = -F.col("best.less")
    own = cut(
        words.join(found.withColumnRenamed("word", "fw"), F.col("word") == F.col("fw"), "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(best_n >= ratio * F.col("n"), F.col("best.near")).alias("form"),
            F.when(best_n >= ratio * F.col("n"), best_n).alias("form_n"),
        )
    )
    ends = _roots(own.where("form is not null")).select(F.col("word").alias("rw"), "root")
    return own.join(ends, F.col("word") == F.col("rw"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
