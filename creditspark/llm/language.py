"""Language of a text by string kernels: blended n-gram presence, Nystroem landmarks, kernel ridge.

The kernel of two texts counts the letter n-grams (n = 1 to 3) that both hold, over the root of
what each holds. Landmark texts give Nystroem features, on which one-versus-rest ridge regression
is fitted to a bounded sample of labelled rows (``SAMPLE`` and ``LANDMARKS`` rows, spread evenly
over the languages by a hash of their ids; with fewer rows, all of them). As the kernel is an
inner product of presence vectors, landmarks, whitening and coefficients fold into one weight per
n-gram and language, so batches of texts are scored by a product of their presence matrix with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditspark.llm.common import rows_of

SAMPLE = 2048
LANDMARKS = 128
RIDGE = 1e-3
GRAMS = 3
UNKNOWN = "und"
_BITS = 21


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str | None) -> np.ndarray:
    """Sorted codes of the different n-grams of a text's letters, lower case, other stretches as one space.

    Empty if the text has no letter.
    """
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.empty(0, np.int64)
    codes = np.r_[32, np.where(letter, codes, 32), 32].astype(np.int64)
    blank = codes == 32
    codes = codes[np.r_[True, ~(blank[1:] & blank[:-1])]]
    found = [codes]
    for _ in range(1, GRAMS):
        found.append(found[-1][:-1] << _BITS | codes[len(found) :])
    every = np.sort(np.concatenate(found))
    return every[np.r_[True, every[1:] != every[:-1]]]


class Model:
    """Weights of n-grams (rows of ``weights``, codes in ``known``) for each language."""

    def __init__(self, langs: list[str], known: np.ndarray, weights: np.ndarray):
        self.langs, self.known, self.weights = langs, known, weights

    def margins(self, texts: list[np.ndarray]) -> np.ndarray:
        """Ridge outputs, about 1 for a text's language and -1 for others: presence matrix times weights."""
        lengths = np.array([len(t) for t in texts])
        codes = np.concatenate(texts)
        at = np.minimum(np.searchsorted(self.known, codes), len(self.known) - 1)
        weights = np.where((self.known[at] == codes)[:, None], self.weights[at], 0)
        starts = np.r_[0, np.cumsum(lengths)[:-1]]
        return np.add.reduceat(weights, starts, axis=0) / np.sqrt(lengths)[:, None]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score (the margin moved to 0 .. 1) of each text; without letters ``und`` and 0."""
        sets = [grams(t) for t in texts]
        out = [(UNKNOWN, 0.0)] * len(texts)
        there = [i for i, s in enumerate(sets) if len(s)]
        if there and self.langs:
            margins = self.margins([sets[i] for i in there])
            best = margins.argmax(axis=1)
            for i, b, m in zip(there, best, margins[np.arange(len(there)), best]):
                out[i] = self.langs[b], float(np.clip((m + 1) / 2, 0, 1))
        return out


def kernel(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Normalised presence kernel of two lists of gram sets, by products of presence matrices."""
    known = np.unique(np.concatenate(b))

    def presence(sets):
        m = np.zeros((len(sets), len(known)), np.float32)
        for row, s in zip(m, sets):
            at = np.minimum(np.searchsorted(known, s), len(known) - 1)
            row[at[known[at] == s]] = 1
        return m

    right = presence(b).T
    rows = [presence(a[i : i + 64]) @ right for i in range(0, len(a), 64)]
    sizes = np.sqrt(np.outer([len(s) for s in a], [len(s) for s in b]))
    return np.concatenate(rows).astype(float) / sizes


def fit(rows: list[tuple[str, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Model of (language, text) rows; every k-th row of a language is a landmark."""
    sets = [(lang, grams(text)) for lang, text in rows]
    sets = [(lang, s) for lang, s in sets if len(s)]
    langs = sorted({lang for lang, _ in sets})
    if not langs:
        return Model([], np.empty(0, np.int64), np.empty((0, 0)))
    by = {lang: [s for x, s in sets if x == lang] for lang in langs}
    most = max(1, landmarks // len(langs))
    marks = [s for lang in langs for s in by[lang][:: max(1, -(-len(by[lang]) // most))]]
    both = kernel(marks, marks)
    values, vectors = np.linalg.eigh(both)
    kept = values > 1e-8 * values.max()
    white = vectors[:, kept] / np.sqrt(values[kept])
    features = kernel([s for _, s in sets], marks) @ white
    signs = np.where(np.array([lang for lang, _ in sets])[:, None] == np.array(langs), 1.0, -1.0)
    # classes weigh alike, however many rows of each there are
    mass = np.array([1 / len(by[lang]) for lang, _ in sets])[:, None]
    gram = features.T @ (mass * features) + ridge * len(langs) * np.eye(features.shape[1])
    shares = white @ np.linalg.solve(gram, features.T @ (mass * signs))
    known = np.unique(np.concatenate(marks))
    weights = np.zeros((len(known), len(langs)))
    for s, share in zip(marks, shares):
        weights[np.searchsorted(known, s)] += share / np.sqrt(len(s))
    return Model(langs, known, weights)


def held_out(id_col: str, folds: int = 3, fold: int = 1) -> Column:
    """Whether crc32 of the id as text falls in the fold kept from learning; a null id does not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def sample(docs: DataFrame, learn: Column, id_col: str, text_col: str, lang_col: str, rows: int = SAMPLE) -> list[tuple[str, str]]:
    """At most ``rows`` (language, text) rows, the same number of each language as far as there are any.

    A row is drawn by a hash of its id and text, with a chance set from its language's count, and
    the draw is then cut to the rows of least hash.
    """
    labelled = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in labelled.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*")).collect()}
    if not counts:
        return []
    each = max(1, rows // len(counts))
    place = F.xxhash64(F.col(id_col), F.col(text_col), F.lit(11)).bitwiseAND(F.lit((1 << 62) - 1))
    limits = F.lit(0)
    chance = {lang: min(1.0, (each + 6 * each**0.5) / n) for lang, n in counts.items()}
    limits = F.element_at(F.create_map(*[F.lit(x) for lang, c in chance.items() for x in (lang, int(c * ((1 << 62) - 1)))]), F.col(lang_col))
    drawn = labelled.where(place <= limits).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), place.alias("place"))
    by: dict[str, list[tuple[int, str]]] = {}
    for lang, text, at in drawn.collect():
        by.setdefault(lang, []).append((at, text))
    return [(lang, text) for lang in sorted(by) for _, text in sorted(by[lang])[:each]]


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows: int = SAMPLE,
    landmarks: int = LANDMARKS,
    ridge: float = RIDGE,
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): the language of each whole text, one row per input row.

    Learns from text and label of rows that are not held out. Null texts and texts without a
    letter are ``und`` with score 0, as is every text if nothing could be learned. Ids may repeat
    or be null (never held out); ties between languages go to the first by name. Other columns
    play no part. No rows give no rows.
    """
    model = fit(sample(docs, ~held_out(id_col), id_col, text_col, lang_col, rows), landmarks, ridge)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, outs, texts in rows_of(batches, 128):
            found = model.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(outs, pa.bool_()), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(score, "doc_id long, held_out boolean, lang_pred string, score double")
