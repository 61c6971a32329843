"""Secrets in texts, by rules whose trigrams are looked up in an inverted index before they are matched.

For each rule's regular expression a Boolean query over trigrams is derived from its parse tree:
text that the rule can match holds every trigram of one of the alternatives (Cox, "Regular
Expression Matching with a Trigram Index"). Documents are indexed in segments; a segment's postings
list, for each trigram that some query names, the documents that hold it, A-Z in lower case. A
rule's query intersects and unites postings, and the rule is matched in the whole text of the
candidates only. Rules without mandatory trigrams are matched in all documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as C
from re import _parser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """What ``pattern`` matches, where its ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The declared rules. Letters within (?ai:...) are ASCII ones in either case.
BASE = (
    Rule("assign", r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
#: Further formats of published credentials.
FURTHER = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("host_token", r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"\bxox[abprs]-[A-Za-z0-9-]{20,}"),
    Rule("maps_key", r"\bAIza[A-Za-z0-9_-]{35}"),
    Rule("payment_key", r"\b[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("url_login", r"\b[a-z][a-z0-9+.-]{1,19}://[^\s:/@]{1,64}:[^\s:/@]{6,64}@[A-Za-z0-9.-]{3,}"),
)

#: Strings a part of a pattern may be expanded to; beyond, their trigrams are used and the strings forgotten.
EXACT = 16
#: Characters of a class up to which each is followed.
_CLASS = 8

# Queries: True (any text), or ("and" / "or", parts), or a trigram (3 bytes).


def _join(kind: str, parts: list):
    """A query of ``parts``, flat, without repeats, True taken out."""
    flat: list = []
    for p in parts:
        if p is True:
            if kind == "or":
                return True
            continue
        for q in p[1] if isinstance(p, tuple) and p[0] == kind else (p,):
            if q not in flat:
                flat.append(q)
    if not flat:
        return True
    return flat[0] if len(flat) == 1 else (kind, tuple(flat))


def _of_strings(strings: set[bytes]):
    """The query of texts that hold one of ``strings``."""
    return _join("or", [_join("and", [s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


@dataclass
class _Part:
    """What a part of a pattern says: ``exact`` strings, all it can match, if few; and a query that holds for it."""

    exact: set[bytes] | None
    query: object = True


def _class_of(items) -> set[bytes] | None:
    """The characters of a class, folded, if few."""
    out: set[bytes] = set()
    for op, value in items:
        if op is C.LITERAL:
            codes = [value]
        elif op is C.RANGE and value[1] - value[0] < _CLASS:
            codes = range(value[0], value[1] + 1)
        else:
            return None
        out |= {chr(c).encode().lower() for c in codes}
    return out if len(out) <= _CLASS else None


def _sequence(parts: list[_Part]) -> _Part:
    """Parts after each other: exact strings are joined while they are few, and give their trigrams where they end."""
    queries, run = [], {b""}
    whole = True
    for p in parts:
        queries.append(p.query)
        if p.exact is not None and len(run) * len(p.exact) <= EXACT:
            run = {a + b for a in run for b in p.exact}
            continue
        queries.append(_of_strings(run))
        whole = False
        # what follows a part that is not exact starts anew
        run = p.exact if p.exact is not None and len(p.exact) <= EXACT else {b""}
    if whole:
        return _Part(run, _join("and", queries))
    return _Part(None, _join("and", [*queries, _of_strings(run)]))


def _read(tree) -> _Part:
    parts: list[_Part] = []
    for op, value in tree:
        if op is C.LITERAL:
            parts.append(_Part({chr(value).encode().lower()}))
        elif op is C.IN:
            parts.append(_Part(_class_of(value)))
        elif op is C.SUBPATTERN:
            parts.append(_read(value[-1]))
        elif op is C.BRANCH:
            ways = [_read(way) for way in value[1]]
            exact = set().union(*(w.exact for w in ways)) if all(w.exact is not None for w in ways) else None
            if exact is not None and len(exact) <= EXACT:
                parts.append(_Part(exact))
            else:
                parts.append(_Part(None, _join("or", [_join("and", [w.query, True if w.exact is None else _of_strings(w.exact)]) for w in ways])))
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
            least, most, inner = value
            part = _read(inner)
            if (least, most) == (0, 1) and part.exact is not None and len(part.exact) < EXACT:
                parts.append(_Part(part.exact | {b""}))
            elif least == 0:
                parts.append(_Part(None))
            elif least == most <= EXACT and part.exact is not None:
                parts += [part] * least
            else:  # at least once: begins with the part, and goes on as it likes
                parts += [part, _Part(None)]
        elif op is C.ATOMIC_GROUP:
            parts.append(_read(value))
        elif op in (C.AT, C.ASSERT, C.ASSERT_NOT):
            continue  # no width; what they ask for is left to the match
        else:
            parts.append(_Part(None))
    return _sequence(parts)


def trigram_query(pattern: str):
    """The Boolean query over folded trigrams (UTF-8) that every text with a match of ``pattern`` fulfils; True: any text."""
    part = _read(_parser.parse(pattern))
    return _join("and", [part.query, True if part.exact is None else _of_strings(part.exact)])


def _named(query) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(_named, query[1]))


class Segment:
    """Postings of some documents: for each of the ``trigrams`` the places of the documents that hold it, rising."""

    def __init__(self, texts: list[bytes], trigrams: list[bytes]):
        self.n = len(texts)
        joined = np.frombuffer(b"\n\n".join([*texts, b""]).lower(), np.uint8)
        ends = np.cumsum([len(t) + 2 for t in texts])
        table = np.zeros(1 << 24, bool)
        codes = [t[0] << 16 | t[1] << 8 | t[2] for t in trigrams]
        table[codes] = True
        first = np.zeros(256, bool)
        first[[t[0] for t in trigrams]] = True
        hits, found = [], []
        for start in range(0, len(joined), 1 << 22):
            part = joined[start : start + (1 << 22) + 2]
            at = np.flatnonzero(first[part[:-2]]) if len(part) > 2 else np.zeros(0, int)
            code = part[at].astype(np.int32) << 16 | part[at + 1].astype(np.int32) << 8 | part[at + 2]
            mine = table[code]
            hits.append(at[mine] + start)
            found.append(code[mine])
        hit = np.concatenate(hits) if hits else np.zeros(0, int)
        code = np.concatenate(found) if found else np.zeros(0, np.int32)
        doc = np.searchsorted(ends, hit, "right")
        keys = np.unique(code.astype(np.int64) << 32 | doc)
        self.postings = {}
        for t, c in zip(trigrams, codes):
            lo, hi = np.searchsorted(keys, [c << 32, (c + 1) << 32])
            self.postings[t] = keys[lo:hi] & 0xFFFFFFFF

    def holds(self, query) -> np.ndarray:
        """Places of the documents that fulfil ``query``, rising."""
        if query is True:
            return np.arange(self.n)
        if isinstance(query, bytes):
            return self.postings[query]
        lists = [self.holds(q) for q in query[1]]
        if query[0] == "or":
            return np.unique(np.concatenate(lists))
        lists.sort(key=len)
        out = lists[0]
        for other in lists[1:]:
            out = np.intersect1d(out, other, assume_unique=True)
        return out


def spans(rule: Rule, match: re.Pattern, text: str) -> list[tuple[int, int]]:
    """The leftmost matches of ``rule`` in a text that do not overlap, in code points, those too short left out."""
    return [(m.start(), m.end()) for m in match.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def _segments(batches: Iterator[pa.RecordBatch], rows: int = 1024, size: int = 8 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches of at most ``rows`` documents and, unless it is a single one, about ``size`` bytes."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
        start = 0
        while start < batch.num_rows:
            n = int(np.searchsorted(np.cumsum(sizes[start : start + rows]), size)) or 1
            part = batch.slice(start, n)
            yield part, part.column(1).to_pylist()
            start += n


def scan(
    docs: DataFrame, rules: tuple[Rule, ...] = BASE + FURTHER, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, found): one row per input row, found the spans (kind, start, end) by start, then by order of the rules.

    Places are code points, the end exclusive. Null and empty texts have no spans; repeated rows
    and rows without id each give their own row; texts are searched whole. Other columns play no
    part. No rows give no rows.
    """
    queries = [trigram_query(r.pattern) for r in rules]
    trigrams = sorted(set().union(*map(_named, queries)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matches = [re.compile(r.pattern) for r in rules]
        for part, texts in _segments(batches):
            texts = [t or "" for t in texts]
            segment = Segment([t.encode() for t in texts], trigrams)
            found: list[list] = [[] for _ in texts]
            for k, (rule, match, query) in enumerate(zip(rules, matches, queries)):
                for at in segment.holds(query).tolist():
                    found[at] += [(start, k, rule.kind, end) for start, end in spans(rule, match, texts[at])]
            out = [[{"kind": kind, "start": start, "end": end} for start, _, kind, end in sorted(own)] for own in found]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, _FOUND)], ["doc_id", "found"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, found array<struct<kind:string,start:long,end:long>>"
    )


_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of ``scan`` with all rules; see there for hard rows."""
    found = F.col("found")
    kinds = [r.kind for r in BASE]

    def text(spans_of):
        return F.array_join(F.transform(spans_of, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def of(*chosen):
        return F.filter(found, lambda x: x["kind"].isin(*chosen))

    return scan(docs, BASE + FURTHER, id_col, text_col).select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(text(of(*kinds)), 256).alias("base_sha256"),
        text(found).alias("spans"),
    )
