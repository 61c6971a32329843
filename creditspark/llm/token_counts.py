"""Exact byte-pair token counts at every prefix of a text, by dynamic programming.

The last token of a prefix's encoding decides everything: a token t may end the encoding of
b[:i] exactly when it encodes to itself and the last token of b[:i - len(t)] stays apart from
it when the two are merged side by side. So ``count[i] = count[i - len(t)] + 1`` runs over a
word's bytes once and leaves the exact count at each of them. Words are the pieces that the
tokenizer's own pattern cuts; the counts of a text are running sums over its words. Truncation
and budget questions then read a stored count instead of encoding again.

Words recur, so each worker keeps the counts of those it has met, in tables of bounded size
(``CACHE`` entries; a full table starts anew). This changes the time only, never a count.
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditspark.llm.common import rows_of

TOKENIZER = "byte_bpe_50k.json"
CACHE = 500_000
#: Unicode's white space, which the tokenizers' patterns mean by \\s.
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_ODD_SPACE = re.compile(f" (?=[{BLANKS}]|$)")
_UNIT = re.compile(f" (?=[^{BLANKS}])")
_RUN = re.compile(f"[{BLANKS}]+")


def tokenizer_path(name: str) -> str:
    """``name`` itself where it is a path, else the place of that public vocabulary."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_alphabet() -> dict[str, int]:
    """Byte-level BPE writes a byte as its own character if that prints, else as the next free one from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Memo(dict):
    """``make`` of a key, kept until ``size`` entries are; then the table starts anew."""

    def __init__(self, make, size: int = CACHE):
        super().__init__()
        self.make, self.size = make, size

    def __missing__(self, key):
        value = self.make(key)
        if len(self) >= self.size:
            self.clear()
        self[key] = value
        return value


def plain_letters(word: str) -> bool:
    """Letters only, by any Unicode version: for others the tokenizer's own pattern is asked."""
    return word.isalpha() and (word.isascii() or max(word) < "\u0250")


class PrefixCounts:
    """Token counts of texts and of all their prefixes, for one byte-level BPE vocabulary."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        byte = byte_alphabet()
        as_bytes = lambda s: bytes(byte[c] for c in s)
        specials = [t["content"] for t in model["added_tokens"]]
        self.ids = {as_bytes(t): i for t, i in model["model"]["vocab"].items() if t not in specials}
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for i, merge in enumerate(model["model"]["merges"]):
            a, b = map(as_bytes, merge.split(" ") if isinstance(merge, str) else merge)
            pair = self.ids[a], self.ids[b]
            self.rank[pair] = i
            self.halves[self.ids[a + b]] = pair
        self.tokens = {i: t for t, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        self.specials = re.compile("|".join(map(re.escape, specials))) if specials else None
        self.cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.stable = Memo(self._stable)
        self.right, self.left = Memo(lambda t: self._edge(t, 1)), Memo(lambda t: self._edge(t, 0))
        self.apart = Memo(self._apart)
        self.word = Memo(lambda word: self.bytes_counts(word.encode())[-1])
        self.first = Memo(self._unit)
        self.spaced = Memo(lambda unit: self._unit(" " + unit))

    # the vocabulary

    def _stable(self, token: int) -> bool:
        """Whether plain BPE (the lowest-ranked neighbours merge, leftmost first) gives a token back."""
        parts = [self.ids[bytes([b])] for b in self.tokens[token]]
        while len(parts) > 1:
            ranks = [self.rank.get(pair, 1 << 60) for pair in zip(parts, parts[1:])]
            best = min(ranks)
            if best == 1 << 60:
                return False
            at = ranks.index(best)
            parts[at : at + 2] = [self.ids[self.tokens[parts[at]] + self.tokens[parts[at + 1]]]]
        return parts == [token]

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """What stands at a token's left (0) or right (1) end while it is merged, and the rank that ends each."""
        edge, until = [], 1 << 60
        while True:
            edge.append((token, until))
            if token not in self.halves:
                return edge
            until = self.rank[self.halves[token]]
            token = self.halves[token][side]

    def _apart(self, pair: int) -> bool:
        """Whether two tokens side by side encode to themselves: no merge ever crosses their border.

        At equal ranks (a run of one token) the leftmost merge comes first.
        """
        for x, x_until in self.right[pair >> 32]:
            for y, y_until in self.left[pair & 0xFFFFFFFF]:
                rank = self.rank.get((x, y))
                if rank is not None and rank < x_until and rank <= y_until:
                    return False
        return True

    # words

    def bytes_counts(self, word: bytes) -> list[int]:
        """Tokens of word[:i] for i from 0 to its length."""
        last, count = [0], [0]
        ids, apart, stable, longest = self.ids, self.apart, self.stable, self.longest
        for i in range(1, len(word) + 1):
            for start in range(i - longest if i > longest else 0, i):
                token = ids.get(word[start:i])
                if token is not None and (not start or apart[last[start] << 32 | token]) and stable[token]:
                    last.append(token)
                    count.append(count[start] + 1)
                    break
            else:
                raise ValueError(f"byte {word[i - 1]} is not in the vocabulary")
        return count

    def _word_prefixes(self, word: str) -> list[int]:
        """Tokens of each prefix of one piece, by characters, from 0 on."""
        counts = self.bytes_counts(word.encode())
        if not word.isascii():
            counts = [counts[i] for i in accumulate((len(c.encode()) for c in word), initial=0)]
        if len(word) == 3 and word[0] == "'" and word[1].isalpha():
            counts[2] = 2  # 'll, 're, 've are one piece, but 'l, 'r, 'v are two
        return counts

    def _pieces(self, text: str) -> list[str]:
        return [text[s:e] for _, (s, e) in self.cut(text)]

    def _unit(self, text: str) -> int:
        core = text.rstrip(".,")
        if plain_letters(core[1:]) and core[0] == " ":
            return self.word[core] + (self.word[text[len(core) :]] if len(core) < len(text) else 0)
        return sum(self.word[p] for p in self._pieces(text))

    # texts

    @staticmethod
    def units(text: str) -> list[str]:
        """Stretches between spaces that begin a word; each but the first goes with its space."""
        return _UNIT.split(text) if _ODD_SPACE.search(text) else text.split(" ")

    def _plain(self, text: str) -> int:
        units = self.units(text)
        return self.first[units[0]] + sum(map(self.spaced.__getitem__, units[1:]))

    def count(self, text: str) -> int:
        """Tokens of the whole text; special strings count as the library takes them: one token."""
        if self.specials is None or not self.specials.search(text):
            return self._plain(text)
        parts = self.specials.split(text)
        return sum(map(self._plain, parts)) + len(parts) - 1

    def _prefixes(self, text: str) -> list[int]:
        """Tokens of text[:i], i from 0 on, for a text without special strings.

        A run of blanks at the end of a prefix is one piece there, though its last blank may
        begin the next word in the whole text.
        """
        out, done = [0], 0
        for piece in self._pieces(text):
            own = self._word_prefixes(piece)
            out.extend(done + n for n in own[1:])
            done += own[-1]
        for run in _RUN.finditer(text):
            start, own = run.start(), self._word_prefixes(run[0])
            out[start + 1 : run.end() + 1] = [out[start] + n for n in own[1:]]
        return out

    def prefixes(self, text: str) -> list[int]:
        """Exact token count of text[:i] for every i from 0 to its length."""
        if self.specials is None or not self.specials.search(text):
            return self._prefixes(text)
        out, base, at = [0], 0, 0
        for m in self.specials.finditer(text):
            part = text[at : m.start()]
            own = self._prefixes(part)
            out.extend(base + n for n in own[1:])
            out.extend(base + self._plain(part + m[0][:i]) for i in range(1, len(m[0])))
            base += own[-1] + 1
            out.append(base)
            at = m.end()
        out.extend(base + n for n in self._prefixes(text[at:])[1:])
        return out

    def measure(self, text: str, limits: tuple[int, ...] = ()) -> tuple[int, ...]:
        """Tokens of the text, and for each limit the characters of its longest prefix of at most so many."""
        if self.specials is not None and self.specials.search(text):
            total = self.count(text)
            counts = self.prefixes(text) if any(total > n for n in limits) else []
            return total, *(len(text) if total <= n else max(i for i, k in enumerate(counts) if k <= n) for n in limits)
        units = self.units(text)
        if not limits:
            return (self._plain(text),)
        sums = list(accumulate(map(self.spaced.__getitem__, units[1:]), initial=self.first[units[0]]))
        return sums[-1], *(len(text) if sums[-1] <= n else self._fit(units, sums, n) for n in limits)

    def _fit(self, units: list[str], sums: list[int], limit: int) -> int:
        """The longest prefix ends in the unit that crosses the limit: the units before it are within."""
        k = bisect_right(sums, limit)
        before = " ".join(units[:k])
        unit = " " + units[k] if k else units[k]
        run = before[len(before.rstrip(BLANKS)) :]  # blanks before the unit may be one piece with its own
        head = (sums[k - 1] if k else 0) - (self._word_prefixes(run)[-1] if run else 0)
        inner = self._prefixes(run + unit)
        best = max((i for i, n in enumerate(inner) if i >= len(run) and head + n <= limit), default=len(run))
        return len(before) - len(run) + best


@lru_cache(maxsize=4)
def counter(tokenizer: str) -> PrefixCounts:
    return PrefixCounts(tokenizer_path(tokenizer))


def token_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = TOKENIZER,
    limits: tuple[int, ...] = (1024,),
    prefixes: bool = False,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, fit_<limit> ..., [prefix_tokens]): one row per input row.

    ``fit_<limit>``: characters of the longest prefix of at most that many tokens (the whole
    text if it fits). ``prefix_tokens``: the exact count of each prefix, by characters from
    0 on. A null text counts as empty: no bytes, no tokens. Ids may be null or repeated; other
    columns play no part. No rows give no rows. Counts equal those of the tokenizers library
    without added tokens.
    """
    schema = "doc_id long, n_bytes long, n_tokens long" + "".join(f", fit_{n} long" for n in limits)
    schema += ", prefix_tokens array<int>" if prefixes else ""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(tokenizer)
        for ids, texts in rows_of(batches):
            texts = [t or "" for t in texts]
            columns = [pa.array(ids, pa.int64()), pa.array([len(t.encode()) for t in texts], pa.int64())]
            found = [own.measure(t, limits) for t in texts]
            columns += [pa.array([f[i] for f in found], pa.int64()) for i in range(1 + len(limits))]
            if prefixes:
                columns.append(pa.array([own.prefixes(t) for t in texts], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in schema.split(", ")])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(count, schema)
