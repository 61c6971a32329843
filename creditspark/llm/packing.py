"""Packing documents into sequences of a fixed length by fitted length patterns.

Only the histogram of piece lengths decides how to pack (Krell et al., "Efficient Sequence
Packing without Cross-contamination"). Lengths are grouped into bins; every pattern of one to
three pieces that fills a sequence is enumerated; non-negative least squares fits how often
each pattern repeats to the histogram; the counts are rounded down and laid out with exact
lengths, and what is left goes, longest first, into the tightest remaining space. All of this
works on at most ``capacity`` counts, whatever the corpus, and says for each (length, rank
among the pieces of that length) where the piece goes. Ranks are taken in parallel.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditspark.llm.common import cut, rows_of
from creditspark.llm.token_counts import BLANKS, Memo, byte_alphabet, plain_letters, tokenizer_path

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 2048
BIN = 8
RANK_ROWS = 1 << 10
_BLANK = re.compile(f"[{BLANKS}]+")
_CONTROL = re.compile("[\x1c-\x1f]")  # str.split parts at these, the tokenizer does not
_ENDS = ".,;:!?"


class WordIds:
    """Token ids (little-endian unsigned 32-bit) of texts whose words the tokenizer takes alone."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        added = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.specials = re.compile("|".join(map(re.escape, added))) if added else None
        self.letter = {b: c for c, b in byte_alphabet().items()}
        self.model = self.lib.model
        self.word = Memo(self._word)
        self.chunk = Memo(self._chunk)

    def _encode(self, text: str) -> bytes:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of one piece in lower case, past the pattern and the normaliser."""
        written = word if word.isascii() else "".join(map(self.letter.__getitem__, word.encode()))
        return np.array([t.id for t in self.model.tokenize(written)], dtype="<u4").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """A stretch without blanks. Letters and the marks behind them never share a token."""
        core = chunk.rstrip(_ENDS)
        low = core.lower()
        if plain_letters(core) and plain_letters(low):
            return self.word[low] + (self.word[chunk[len(core) :]] if len(core) < len(chunk) else b"")
        return self._encode(chunk)

    def ids(self, text: str) -> bytes:
        if self.specials is not None and self.specials.search(text):
            return self._encode(text)
        chunks = _BLANK.split(text) if _CONTROL.search(text) else text.split()
        return b"".join(map(self.chunk.__getitem__, filter(None, chunks)))


@lru_cache(maxsize=2)
def word_ids(tokenizer: str) -> WordIds:
    return WordIds(tokenizer_path(tokenizer))


def pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, capacity: int = CAPACITY
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and a closing id 0, cut at ``capacity``."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, step = word_ids(tokenizer), 4 * capacity
        for ids, texts in rows_of(batches):
            rows = []
            for doc_id, text in zip(ids, texts):
                data = own.ids(text or "") + b"\0\0\0\0"
                for i, at in enumerate(range(0, len(data), step)):
                    part = data[at : at + step]
                    rows.append((doc_id, i, at // 4, len(part) // 4, zlib.crc32(part)))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(split, "doc_id long, piece int, start long, length long, ids_crc32 long")


def patterns(units: int, most: int = 3) -> list[tuple[int, ...]]:
    """All ways to fill ``units`` with one to ``most`` parts, parts descending."""

    def fill(left: int, parts: int, top: int):
        if parts == 1:
            if left <= top:
                yield (left,)
            return
        for first in range(min(top, left - parts + 1), 0, -1):
            for rest in fill(left - first, parts - 1, first):
                yield (first, *rest)

    return [p for n in range(1, min(most, units) + 1) for p in fill(units, n, units)]


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """argmin |ax - b| over x >= 0, by active sets (Lawson and Hanson)."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], dtype=bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(3 * a.shape[0]):
        gain = a.T @ (b - a @ x)
        gain[active] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= tolerance:
            break
        active[best] = True
        while True:
            on = np.flatnonzero(active)
            trial = np.linalg.lstsq(a[:, on], b, rcond=None)[0]
            if len(on) == 0 or trial.min() > 0:
                x[:] = 0
                x[on] = trial
                break
            low = trial <= 0
            step = np.min(x[on][low] / (x[on][low] - trial[low]))
            x[on] += step * (trial - x[on])
            x[on[x[on] <= 1e-12]] = 0
            active[on[x[on] <= 0]] = False
    return x


class _Layout:
    """Where pieces go: runs of sequences that hold the same lengths at the same offsets.

    A segment (length, first rank, sequences, pieces in each, first sequence, offset) sends the
    pieces of consecutive ranks to consecutive sequences.
    """

    def __init__(self, counts: dict[int, int]):
        self.left = dict(counts)
        self.rank = dict.fromkeys(counts, 0)
        self.segments: list[tuple[int, int, int, int, int, int]] = []
        self.sequences = 0
        self.open: list[tuple[int, int, int]] = []  # (room, first sequence, sequences), sorted

    def place(self, length: int, sequences: int, each: int, base: int, offset: int) -> None:
        self.segments.append((length, self.rank[length], sequences, each, base, offset))
        self.rank[length] += sequences * each
        self.left[length] -= sequences * each

    def leave(self, room: int, base: int, sequences: int) -> None:
        if room and sequences:
            insort(self.open, (room, base, sequences))


def _exact(left: dict[int, int], there: list[int], bins: dict[int, list[int]], shape: tuple[int, ...], room: int, width: int):
    """Lengths still there for a pattern: the longest of each bin, and last the longest that the room takes.

    ``there``: the lengths in ascending order. Empty if a bin is used up, or the last would leave two bins' width.
    """
    chosen: list[int] = []
    for u in shape[:-1]:
        n = next((n for n in bins.get(u, ()) if left[n] > chosen.count(n)), None)
        if n is None:
            return []
        chosen.append(n)
        room -= n
    for at in range(bisect_right(there, room) - 1, -1, -1):
        if there[at] <= room - 2 * width:
            break
        if left[there[at]] > chosen.count(there[at]):
            return [*chosen, there[at]]
    return []


def lay_out(counts: dict[int, int], capacity: int = CAPACITY, width: int = BIN) -> _Layout:
    """The packing of a histogram of piece lengths (all at most ``capacity``)."""
    layout = _Layout(counts)
    units = capacity // width
    if units * width == capacity and counts:
        bins: dict[int, list[int]] = {}
        for length in sorted(counts, reverse=True):
            bins.setdefault(-(-length // width), []).append(length)
        there, shapes = sorted(counts), patterns(units)
        fill = np.zeros((units, len(shapes)))
        for j, shape in enumerate(shapes):
            for u in shape:
                fill[u - 1, j] += 1
        want = np.array([sum(counts[n] for n in bins.get(u, [])) for u in range(1, units + 1)], dtype=float)
        repeats = nnls(fill, want)
        for j in np.argsort(-repeats, kind="stable")[: int((repeats >= 1).sum())]:
            times = int(repeats[j] + 1e-6)
            while times:
                chosen = _exact(layout.left, there, bins, shapes[j], capacity, width)
                if not chosen:
                    break
                run = min([times, *(layout.left[n] // chosen.count(n) for n in set(chosen))])
                offset = 0
                for n in chosen:
                    layout.place(n, run, 1, layout.sequences, offset)
                    offset += n
                layout.leave(capacity - offset, layout.sequences, run)
                layout.sequences += run
                times -= run
    for length in sorted(counts, reverse=True):
        while layout.left[length]:
            at = bisect_left(layout.open, (length, -1, -1))
            if at == len(layout.open):
                each = capacity // length
                whole = -(-layout.left[length] // each)
                layout.leave(capacity, layout.sequences, whole)
                layout.sequences += whole
                continue
            room, base, there = layout.open.pop(at)
            each = min(room // length, layout.left[length])
            run = min(there, layout.left[length] // each)
            layout.place(length, run, each, base, capacity - room)
            layout.leave(room - each * length, base, run)
            layout.leave(room, base + run, there - run)
    return layout


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY, width: int = BIN, rank_rows: int = RANK_ROWS) -> DataFrame:
    """``cut_pieces`` (as ``pieces`` gives) with sequence_id and offset.

    The driver sees one count per length: at most ``capacity`` rows. Ranks within a length are
    row numbers within parts of about ``rank_rows`` pieces plus the sizes of the parts before,
    so a length that holds a third of all pieces spreads over many tasks. Equal rows may change
    places with each other; the result as a whole does not change.
    """
    rows = cut(cut_pieces)
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    layout = lay_out(counts, capacity, width)
    parts = F.array(*[F.lit(-(-counts.get(n, 0) // rank_rows) or 1) for n in range(capacity + 1)])
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.get(parts, F.col("length"))))
    sizes = dealt.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (
        dealt.withColumn("rank", F.row_number().over(within) - 1)
        .join(firsts, ["length", "part"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("first")).alias("rank"))
    )
    segments = np.array(sorted(layout.segments), dtype=np.int64).reshape(-1, 6)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = (segments[:, 0] << 48) | segments[:, 1]
        for batch in batches:
            length, rank = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "rank"))
            segment = segments[np.searchsorted(keys, (length << 48) | rank, side="right") - 1]
            nth = rank - segment[:, 1]
            sequence = segment[:, 4] + nth // segment[:, 3]
            offset = segment[:, 5] + nth % segment[:, 3] * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:5], "sequence_id", "offset"]
            )

    return ranked.mapInArrow(
        send, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY,
    width: int = BIN,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): where each piece of each row goes.

    A null or empty text is one piece of the closing id alone. Rows are packed one by one, also
    where ids or whole rows repeat or the id is null. Pieces fill a sequence from offset 0
    without gaps. Other columns play no part. No rows give no rows.
    """
    return pack(pieces(docs, id_col, text_col, tokenizer, capacity), capacity, width)
