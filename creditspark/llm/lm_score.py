"""Documents scored by the cross-entropy difference of two word-bigram models.

The target model is counted over the rows marked as target, the background model over all rows,
in the same way and over one vocabulary (Moore and Lewis, "Intelligent Selection of Language
Model Training Data"). The vocabulary is every word that occurs ``MIN_COUNT`` times, and a pair of
words has its own estimate if it occurs ``MIN_COUNT`` times, and else backs off; a word or pair of
the target is one of all rows, so the target's clause is the same. The tables thus grow with the
corpus, and stay in Spark.

The ``COMMON`` most frequent words are sent to the tasks, where they have numbers by their rank. Documents are
taken in blocks of about ``BLOCK`` words; a block's pairs of numbered words are dealt into parts by
the pair, as one packed row a part. A part counts its pairs; what follows a word is summed over the
parts; then each part gives every document of a block the sum of the losses of its pairs. A pair
with a word beyond those sent is counted and resolved by joins instead. What is sent changes no
result. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditspark.llm.common import cut, small
from creditspark.session import stored

MIN_COUNT = 2
COMMON = 1 << 21
DISCOUNT = 0.75
BLOCK = 500_000  # words of a block of documents
PART_WORDS = 3_000_000  # words of all documents for each part
WANTED_ROWS = 1_000_000  # ids of the target up to which they are sent to the tasks

#: What str.split() takes as blank.
_BLANK = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_START, _OTHER = 1, 0  # stand before a text's first word, and for words outside the vocabulary
_SHIFT = 24  # a pair's code: number of the word before, then of the word
_FIXED = float(1 << 34)  # losses are handed on in steps of 2^-34
_HEAD, _RARE, _KEPT, _CONTEXT, _TOKENS, _SUMS, _RARE_SUMS = range(7)
_ROW = "kind int, part int, block long, ord int, doc long, n long, v long, w long, flags int, x double, y double, a binary, b binary, c binary"
_NAMES = [f.split()[0] for f in _ROW.split(", ")]
_TYPES = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
_FIELDS = {f.split()[0]: _TYPES[f.split()[1]] for f in _ROW.split(", ")}


def _rows(size: int, **columns) -> pa.RecordBatch:
    """A batch of ``size`` rows of ``_ROW``; single numbers stand for all rows, columns not named are null."""
    out = []
    for name, kind in _FIELDS.items():
        value = columns.get(name)
        if value is None:
            out.append(pa.nulls(size, kind))
        elif isinstance(value, int):
            out.append(pa.array(np.full(size, value), kind))
        else:
            out.append(value if isinstance(value, pa.Array) else pa.array(value, kind))
    return pa.RecordBatch.from_arrays(out, _NAMES)


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers in few bytes: their first bytes, then their second bytes and so on, compressed."""
    data = np.ascontiguousarray(numbers, "<i8").view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], size, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<i8").ravel()


def _hashes(text: Column) -> Column:
    """Hashes of the words of a text, in order."""
    words = F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), _BLANK, " " * len(_BLANK)), " "), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _words_of(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The words of all rows, joined, and how many each row has."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy()[offsets[0] : offsets[-1]], np.diff(offsets)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(w, n_all, n_target) of (words, target), summed within a task as far as a table of them fits."""
    words: list = []
    marks: list = []

    def out():
        every, at, n = np.unique(np.concatenate(words), return_inverse=True, return_counts=True)
        target = np.bincount(at, np.concatenate(marks), len(every)).astype(np.int64)
        words.clear()
        marks.clear()
        for k in range(0, len(every), 200_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[k : k + 200_000]) for x in (every, n, target)], ["w", "n_all", "n_target"])

    for batch in batches:
        w, sizes = _words_of(batch.column(0))
        words.append(w)
        marks.append(np.repeat(batch.column(1).to_numpy(zero_copy_only=False).astype(bool), sizes))
        if sum(map(len, words)) >= 4_000_000:
            yield from out()
    if sum(map(len, words)):
        yield from out()


def _mixed(codes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (x ^ (x >> np.uint64(32))) >> np.uint64(8)


class _Sent:
    """The words sent, as hashes in order, and their numbers: 2 for the most frequent and so on."""

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        self.words = words
        self.number = np.empty(len(words), np.int32)
        self.number[np.argsort(-counts, kind="stable")] = np.arange(2, len(words) + 2)

    def numbers(self, words: np.ndarray, every: bool) -> np.ndarray:
        """Numbers of words, 0 for those outside the vocabulary and -1 if that is open."""
        if not len(self.words):
            return np.full(len(words), 0 if every else -1, np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, self.number[at].astype(np.int64), 0 if every else -1)

    def hashes(self) -> np.ndarray:
        """The hash of each number; those that stand for no word are themselves."""
        out = np.array([_OTHER, _START, *[0] * len(self.words)], np.int64)
        out[self.number] = self.words
        return out


def _block_rows(block: int, docs: list, marks: np.ndarray, words: np.ndarray, sizes: np.ndarray, sent: _Sent, every: bool, parts: int) -> Iterator[pa.RecordBatch]:
    """Rows of one block of documents: heads, pairs of numbered words packed by part, other pairs."""
    n = len(docs)
    yield _rows(n, kind=_HEAD, part=block % parts, block=block, ord=np.arange(n), doc=pa.array(docs, pa.int64()), n=sizes)
    if not len(words):
        return
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    row = np.repeat(np.arange(n), sizes)
    after = sent.numbers(words, every)
    before = np.r_[_START, after[:-1]]
    before[first] = _START
    dense = (before >= 0) & (after >= 0)
    if not dense.all():
        v, w = np.r_[_START, words[:-1]], words
        v[first] = _START
        other = np.flatnonzero(~dense)
        key = np.stack([row[other], v[other], w[other]])
        order = np.lexsort(key[::-1])
        key = key[:, order]
        new = np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0)]
        starts = np.flatnonzero(new)
        counts = np.diff(np.r_[starts, key.shape[1]])
        at = other[order][starts]
        flags = (before[at] >= 0) * 1 + (after[at] >= 0) * 2 + marks[row[at]] * 4
        for k in range(0, len(at), 200_000):
            s = slice(k, k + 200_000)
            yield _rows(len(at[s]), kind=_RARE, part=block % parts, block=block, ord=row[at[s]], n=counts[s], v=v[at[s]], w=w[at[s]], flags=flags[s])
    code = (before[dense] << _SHIFT) | after[dense]
    if not len(code):
        return
    row = row[dense]
    part = (_mixed(code) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((code, row, part))
    code, row, part = code[order], row[order], part[order]
    starts = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (row[1:] != row[:-1])])
    counts = np.diff(np.r_[starts, len(code)])
    code, row, part = code[starts], row[starts], part[starts]
    edges = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(part)]
    for lo in range(0, len(edges) - 1, 64):
        some = list(zip(edges[lo : lo + 64], edges[lo + 1 : lo + 65]))
        a, b, c = [], [], []
        for i, j in some:
            ords, first_of, entries = np.unique(row[i:j], return_index=True, return_counts=True)
            steps = np.diff(np.r_[0, code[i:j]])  # rising within a document
            steps[first_of] = code[i:j][first_of]
            a.append(_packed(steps))
            b.append(_packed(np.r_[np.diff(np.r_[0, ords]) * 2 + marks[ords], entries]))
            c.append(_packed(counts[i:j]))
        yield _rows(len(some), kind=_TOKENS, part=part[[i for i, _ in some]], block=block, a=a, b=b, c=c)


def _codes(a: bytes, entries: np.ndarray) -> np.ndarray:
    """The codes of a packed row, whose documents have so many entries each."""
    sums = np.cumsum(_unpacked(a))
    first = np.cumsum(entries) - entries
    before = np.r_[0, sums[first[1:] - 1]]
    return sums - np.repeat(before, entries)


def _documents(b: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places in the block, target?, entries) of the documents of a packed row."""
    both = _unpacked(b)
    steps, entries = both[: len(both) // 2], both[len(both) // 2 :]
    return np.cumsum(steps >> 1), (steps & 1).astype(bool), entries


def _blocks(batches: Iterator[pa.RecordBatch], sent: _Sent, every: bool, parts: int) -> Iterator[pa.RecordBatch]:
    base = TaskContext.get().partitionId() << 32
    held: list[tuple] = []
    size = number = 0
    for batch in batches:
        ids, marks = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        words, sizes = _words_of(batch.column(2))
        ends = np.cumsum(sizes)
        start = 0
        while start < len(ids):
            from_ = ends[start] - sizes[start]
            stop = max(start + 1, int(np.searchsorted(ends, from_ + BLOCK)))
            held.append((ids[start:stop], marks[start:stop], words[from_ : ends[stop - 1]], sizes[start:stop]))
            size += len(held[-1][2])
            start = stop
            if size >= BLOCK:
                yield from _block_rows(base | number, [i for h in held for i in h[0]], *(np.concatenate([h[k] for h in held]) for k in (1, 2, 3)), sent, every, parts)
                held, size, number = [], 0, number + 1
    if held:
        yield from _block_rows(base | number, [i for h in held for i in h[0]], *(np.concatenate([h[k] for h in held]) for k in (1, 2, 3)), sent, every, parts)


def _counted(batches: Iterator[pa.RecordBatch], min_count: int) -> Iterator[pa.RecordBatch]:
    """The rows of a part, its pairs of ``min_count`` occurrences and what follows their first words before them."""
    tokens: list[pa.RecordBatch] = []
    codes, weights, targets = [], [], []
    for batch in batches:
        kinds = batch.column(0).to_numpy()
        if (kinds != _TOKENS).any():
            yield batch.filter(pa.array(kinds != _TOKENS))
        own = batch.filter(pa.array(kinds == _TOKENS))
        if own.num_rows:
            tokens.append(own)
            for a, b, c in zip(*(own.column(x).to_pylist() for x in "abc")):
                n = _unpacked(c)
                _, marks, entries = _documents(b)
                codes.append(_codes(a, entries))
                weights.append(n)
                targets.append(n * np.repeat(marks, entries))
    if codes:
        every, at = np.unique(np.concatenate(codes), return_inverse=True)
        n_all = np.bincount(at, np.concatenate(weights), len(every)).astype(np.int64)
        n_target = np.bincount(at, np.concatenate(targets), len(every)).astype(np.int64)
        kept = n_all >= min_count
        every, n_all, n_target = every[kept], n_all[kept], n_target[kept]
        yield _rows(1, kind=_KEPT, a=[_packed(np.diff(np.r_[0, every]))], b=[_packed(n_all)], c=[_packed(n_target)])
        if len(every):
            v, first = np.unique(every >> _SHIFT, return_index=True)
            sums = [np.add.reduceat(x, first) for n in (n_target, n_all) for x in (n, _taken4(n))]
            yield _rows(1, kind=_CONTEXT, a=[_packed(v)], b=[_packed(np.concatenate(sums))])
        yield from tokens


def _taken4(n: np.ndarray) -> np.ndarray:
    """Four times what a pair keeps of its count."""
    return np.maximum(4 * n - int(4 * DISCOUNT), 0)


def _contexts(batches: Iterator[pa.RecordBatch], sent: _Sent) -> Iterator[pa.RecordBatch]:
    """(v, n_target, taken4_target, n_all, taken4_all) of what the parts say of words as hashes."""
    names = sent.hashes()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            v = _unpacked(a)
            yield pa.RecordBatch.from_arrays([pa.array(names[v]), *[pa.array(x) for x in _unpacked(b).reshape(4, -1)]], ["v", "n_target", "t_target", "n_all", "t_all"])


class _Losses:
    """Losses of pairs of numbered words: ``free`` of the word before and ``base`` of the word, (2, numbers) each."""

    def __init__(self, unigrams: np.ndarray, followed: np.ndarray, taken: np.ndarray, totals: list[int], size: int):
        self.context = np.maximum(np.maximum(unigrams, followed), 1)
        self.base = (unigrams + 1) / (np.array(totals, float)[:, None] + size + 1)
        self.free = 1 - taken / self.context

    def kept(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        v, w = codes >> _SHIFT, codes & ((1 << _SHIFT) - 1)
        return -np.log(np.maximum(counts - DISCOUNT, 0) / self.context[:, v] + self.free[:, v] * self.base[:, w])

    def backed_off(self, codes: np.ndarray) -> np.ndarray:
        return -np.log(self.free[:, codes >> _SHIFT] * self.base[:, codes & ((1 << _SHIFT) - 1)])


def _resolved(batches: Iterator[pa.RecordBatch], losses: _Losses) -> Iterator[pa.RecordBatch]:
    """For each packed row the sums of losses of its documents; the kept pairs of the part come before."""
    known, whole = np.zeros(0, np.int64), np.zeros((2, 0))
    for batch in batches:
        for kind, block, a, b, c in zip(*(batch.column(x).to_pylist() for x in ("kind", "block", "a", "b", "c"))):
            if kind == _KEPT:
                known = np.cumsum(_unpacked(a))
                whole = losses.kept(known, np.stack([_unpacked(c), _unpacked(b)]))
                continue
            ords, _, entries = _documents(b)
            codes = _codes(a, entries)
            each = losses.backed_off(codes)
            if len(known):
                at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
                own = known[at] == codes
                each[:, own] = whole[:, at[own]]
            sums = np.add.reduceat(each * _unpacked(c), np.cumsum(entries) - entries, axis=1)
            x, y = np.rint(sums * _FIXED).astype(np.int64)
            yield _rows(1, kind=_SUMS, block=block, a=[_packed(np.diff(np.r_[0, ords]))], b=[_packed(x)], c=[_packed(y)])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_words, loss_target, loss_background) from rows sorted by block, its heads first."""
    block, ids, sizes = None, [], []
    sums = np.zeros((2, 0))

    def out():
        n = np.array(sizes, np.int64)
        some = n > 0
        whole = sums if sums.shape[1] else np.zeros((2, len(ids)))
        mean = [pa.array(s / np.maximum(n, 1), mask=~some) for s in whole]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n), *mean], ["doc_id", "n_words", "loss_target", "loss_background"])

    for batch in batches:
        for kind, own, ord_, doc, n, x, y, a, b, c in zip(*(batch.column(k).to_pylist() for k in ("kind", "block", "ord", "doc", "n", "x", "y", "a", "b", "c"))):
            if own != block:
                if ids:
                    yield out()
                block, ids, sizes, sums = own, [], [], np.zeros((2, 0))
            if kind == _HEAD:
                ids.append(doc)
                sizes.append(n)
                continue
            if not sums.shape[1]:
                sums = np.zeros((2, len(ids)))
            if kind == _SUMS:
                sums[:, np.cumsum(_unpacked(a))] += np.stack([_unpacked(b), _unpacked(c)]) / _FIXED
            else:
                sums[:, ord_] += x, y
    if ids:
        yield out()


def _rare_losses(rare: DataFrame, known: DataFrame, dense_contexts: DataFrame, numbers: dict, min_count: int) -> tuple[DataFrame, DataFrame]:
    """(contexts of all words, sums of the rare pairs by document): pairs with a word that was not sent, by joins.

    The word sent of such a pair is hot, so it takes no part in the joins on words.
    """
    of = ("target", "all")
    beside = F.xxhash64("block", "ord", "v", "w")
    sent_v, sent_w = F.col("flags").bitwiseAND(1) > 0, F.col("flags").bitwiseAND(2) > 0
    words = known.select("w")
    mapped = cut(
        rare.withColumn("jv", F.when(sent_v, beside).otherwise(F.col("v")))
        .withColumn("jw", F.when(sent_w, beside).otherwise(F.col("w")))
        .join(words.withColumnRenamed("w", "kv"), F.col("jv") == F.col("kv"), "left")
        .join(words.withColumnRenamed("w", "kw"), F.col("jw") == F.col("kw"), "left")
        .select(
            "block",
            "ord",
            F.when(sent_v, F.col("v")).otherwise(F.coalesce("kv", F.lit(_OTHER))).alias("v"),
            F.when(sent_w, F.col("w")).otherwise(F.coalesce("kw", F.lit(_OTHER))).alias("w"),
            "n",
            (F.col("flags") >= 4).alias("target"),
        )
    )
    pairs = cut(mapped.groupBy("v", "w").agg(F.sum("n").alias("n_all"), F.sum(F.when(F.col("target"), F.col("n")).otherwise(0)).alias("n_target")))
    taken4 = lambda m: F.greatest(4 * F.col(f"n_{m}") - int(4 * DISCOUNT), F.lit(0))
    kept = pairs.where(F.col("n_all") >= min_count).select("v", *[F.col(f"n_{m}") for m in of], *[taken4(m).alias(f"t_{m}") for m in of])
    contexts = cut(dense_contexts.unionByName(kept).groupBy("v").agg(*[F.sum(f"{k}_{m}").alias(f"{k}_{m}") for k in ("n", "t") for m in of]))
    unigram = known.select(F.col("w").alias("uw"), *[F.col(f"n_{m}").alias(f"u_{m}") for m in of])

    def whole(m: str, word: str) -> Column:
        return F.when(F.col(word) == _OTHER, F.lit(numbers["other"][of.index(m)])).otherwise(F.coalesce(F.col(f"u_{m}"), F.lit(0)))

    before = contexts.join(unigram, F.col("v") == F.col("uw"), "left").select(
        F.col("v").alias("cv"),
        *[F.greatest(whole(m, "v"), F.col(f"n_{m}"), F.lit(1)).alias(f"context_{m}") for m in of],
        *[F.col(f"t_{m}").alias(f"gone_{m}") for m in of],
    )

    def loss(m: str) -> Column:
        base = (whole(m, "w") + 1) / F.lit(float(numbers["totals"][of.index(m)] + numbers["size"] + 1))
        own = F.when(F.col("n_all") >= min_count, taken4(m) / 4).otherwise(0.0)
        share = lambda x: F.coalesce(x / F.col(f"context_{m}"), F.lit(0.0))
        return -F.log(share(own) + (1 - share(F.col(f"gone_{m}") / 4)) * base)

    answers = cut(
        pairs.join(before, F.col("v") == F.col("cv"), "left")
        .join(unigram, F.col("w") == F.col("uw"), "left")
        .select(F.col("v").alias("av"), F.col("w").alias("aw"), loss("target").alias("lt"), loss("all").alias("lb"))
    )
    # both sides computed first, so that a pair that many documents hold can be split
    met = mapped.join(answers.hint("merge"), (F.col("v") == F.col("av")) & (F.col("w") == F.col("aw")))
    return contexts, met.groupBy("block", "ord").agg(F.sum(F.col("n") * F.col("lt")).alias("x"), F.sum(F.col("n") * F.col("lb")).alias("y"))


def cross_entropy_difference(
    docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_count: int = MIN_COUNT, common: int = COMMON
) -> DataFrame:
    """(doc_id, n_words, loss_target, loss_background, score): one row per input row.

    ``targets`` (column ``id_col``) names the rows that are like what is wanted; an id named twice
    counts once, one that no row has not at all. Losses are nats per word, ``score`` is target
    less background: the lower, the more like the target. Null, empty and wordless texts have no
    words and null losses. Rows of equal ids are each counted and scored; a null id is no
    target. Other columns play no part. No rows give no rows; without targets the target model
    knows the vocabulary only, all words alike. ``common``: the number of words sent to the tasks.
    """
    spark = docs.sparkSession
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    wanted = small(cut(targets.select(F.col(id_col).cast("long").alias("wanted")).where("wanted is not null").distinct()), WANTED_ROWS)
    marked = chosen.join(wanted, F.col("doc_id") == F.col("wanted"), "left").select(
        "doc_id", F.col("wanted").isNotNull().alias("target"), _hashes(F.col("text")).alias("words")
    )
    counted_words = marked.select("words", "target").mapInArrow(_word_counts, "w long, n_all long, n_target long")
    counts = stored(counted_words.groupBy("w").agg(F.sum("n_all").alias("n_all"), F.sum("n_target").alias("n_target")), "words")
    known = counts.where(F.col("n_all") >= min_count)
    totals = [x or 0 for x in counts.agg(F.sum("n_target"), F.sum("n_all")).first()]
    in_vocabulary = known.agg(F.sum("n_target"), F.sum("n_all"), F.count("*")).first()
    size = in_vocabulary[2]
    other = [t - (x or 0) for t, x in zip(totals, in_vocabulary)]
    # at most ``common`` words, those of the highest counts
    bar = known.groupBy("n_all").count().orderBy(F.desc("n_all")).limit(common).toPandas()  # a row a count
    frequent = bar["n_all"][bar["count"].cumsum() <= common]

    def is_top(words: DataFrame) -> DataFrame:
        return words.where(F.col("n_all") >= int(frequent.min()) if len(frequent) else F.lit(False))

    top = is_top(known).toArrow().sort_by("w")
    sent, every = _Sent(top.column("w").to_numpy(), top.column("n_all").to_numpy()), top.num_rows == size
    shared = spark.sparkContext.broadcast(sent)
    parts = max(1, -(-totals[1] // PART_WORDS))

    dealt = marked.mapInArrow(lambda batches: _blocks(batches, shared.value, every, parts), _ROW)
    placed = dealt.repartitionById(parts, "part")
    counted = cut(placed.mapInArrow(lambda batches: _counted(batches, min_count), _ROW))
    contexts = counted.where(F.col("kind") == _CONTEXT).select("a", "b").mapInArrow(
        lambda batches: _contexts(batches, shared.value), "v long, n_target long, t_target long, n_all long, t_all long"
    )
    heads = counted.where(F.col("kind") == _HEAD)
    if every:
        contexts = contexts.groupBy("v").agg(*[F.sum(c).alias(c) for c in ("n_target", "t_target", "n_all", "t_all")])
        rare_sums = None
    else:
        rare = counted.where(F.col("kind") == _RARE).select("block", "ord", "v", "w", "n", "flags")
        contexts, rare_sums = _rare_losses(rare, known, contexts, {"other": other, "totals": totals, "size": size}, min_count)
        # those of the words sent and of the two that stand for none
        few = is_top(known).select(F.col("w").alias("sw"))
        contexts = contexts.join(few, F.col("v") == F.col("sw"), "left").where(f"sw is not null or v in ({_OTHER}, {_START})").drop("sw")
    context = contexts.toArrow()
    unigrams, followed, taken = (np.zeros((2, top.num_rows + 2)) for _ in range(3))
    unigrams[:, 0] = other
    unigrams[:, sent.number] = np.stack([top.column(c).to_numpy() for c in ("n_target", "n_all")])
    v = context.column("v").to_numpy()
    place = np.where((v == _OTHER) | (v == _START), v, sent.numbers(v, False))
    for k, m in enumerate(("target", "all")):
        followed[k, place] = context.column(f"n_{m}").to_numpy()
        taken[k, place] = context.column(f"t_{m}").to_numpy() / 4
    losses = spark.sparkContext.broadcast(_Losses(unigrams, followed, taken, totals, size))

    sums = counted.where(F.col("kind").isin(_KEPT, _TOKENS)).mapInArrow(lambda batches: _resolved(batches, losses.value), _ROW)
    rows = heads.unionByName(sums)
    if rare_sums is not None:
        rows = rows.unionByName(rare_sums.withColumn("kind", F.lit(_RARE_SUMS)), allowMissingColumns=True)
    found = rows.repartition("block").sortWithinPartitions("block", "kind", "ord").mapInArrow(
        _added, "doc_id long, n_words long, loss_target double, loss_background double"
    )
    return found.select("*", (F.col("loss_target") - F.col("loss_background")).alias("score"))
