"""Quality rules by robust multivariate outliers: counts of a text in plain column functions,
then minimum-covariance-determinant estimates per language and source.

Everything here is DataFrame functions. A text's counts come from array functions within its
row; the estimates from sums per group that combine before the shuffle. Statistics are whole
multiples of 1/1024, so that sums are exact in any order and order statistics need one count
per different value, however many rows a group holds.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditspark.llm.common import cut, small

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT = 50  # per cent of words
SCALE = 1024
CORE = 0.75  # share of a group that the estimate rests on
TAIL = 1e-3  # chance that a row of a normal group is rejected; with the floors of STATISTICS, repeats act from 43 per cent on
MIN_GROUP = 100
STEPS = 12
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, also where lambdas read it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words in windows of three that occur at least twice, the first included."""

    def covered(at: Column) -> Column:
        reach = F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3))))
        return F.aggregate(reach, F.lit(0).cast("long"), lambda a, x: a + x)

    def marked(s: Column) -> Column:
        same = lambda x, i: F.coalesce(F.get(s, i)["h"] == x["h"], F.lit(False))
        twice = F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1))
        return let(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

    def windows(h: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(h) - 3),
            lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)),
        )

    def count(w: Column) -> Column:
        pairs = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(let(pairs, marked))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(let(let(hashes, windows), count))


def text_counts(text: Column) -> Column:
    """Struct of ``COUNTS`` and n_lines (lines with a word) of a text; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(F.translate(text, "\t\n\x0b\x0c\r", "     "), " "), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(" \t\n\x0b\x0c\r")) != "")
    from_words = let(
        words,
        lambda ws: F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.aggregate(ws, F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
            _repeat_words(ws).alias("n_repeat_words"),
        ),
    )
    from_lines = let(
        lines,
        lambda ls: F.struct(
            F.size(ls).cast("long").alias("n_lines"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
        ),
    )
    symbols = F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols")
    return F.struct(from_words.alias("w"), from_lines.alias("l"), symbols)


def counted(docs: DataFrame, id_col: str, text_col: str, group_cols: tuple[str, ...]) -> DataFrame:
    """(doc_id, group, n_lines and ``COUNTS``); group: the values of ``group_cols``, nulls included."""
    group = F.to_json(F.struct(*[F.col(c).alias(f"g{i}") for i, c in enumerate(group_cols)]))
    return docs.select(
        F.col(id_col).alias("doc_id"), group.alias("group"), text_counts(F.col(text_col)).alias("c")
    ).select("doc_id", "group", "c.w.*", "c.l.*", "c.n_symbols")


def base_failed() -> Column:
    return F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT} * n_words")


#: Statistic, its value, and the spread below which no group's estimate falls.
STATISTICS: list[tuple[str, str, float]] = [
    ("symbols", "log2(1 + 64 * n_symbols / greatest(n_words, 1))", 0.4),
    ("word_length", "log2(greatest(word_chars, 1) / greatest(n_words, 1))", 0.08),
    ("dup_lines", "n_dup_lines / greatest(n_lines, 1)", 0.1),
    ("repeats", "n_repeat_words / greatest(n_words, 1)", 0.1),
]
_N = range(len(STATISTICS))


def _vector() -> list[Column]:
    return [F.expr(f"cast(round({SCALE} * ({e})) as bigint)").alias(f"x{i}") for i, (_, e, _) in enumerate(STATISTICS)]


def chi_square_above(x: float, dof: int) -> float:
    """P(chi-square > x) for an even number of degrees of freedom."""
    term = total = 1.0
    for k in range(1, dof // 2):
        term *= x / 2 / k
        total += term
    return math.exp(-x / 2) * total


def chi_square_point(above: float, dof: int) -> float:
    low, high = 0.0, 1e4
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_above(mid, dof) > above else (low, mid)
    return high


def _distance() -> Column:
    """Squared Mahalanobis distance; w is the inverse of the covariance's Cholesky factor."""
    parts = [sum((F.col(f"w{i}{j}") * (F.col(f"x{j}") - F.col(f"m{j}")) for j in range(i + 1)), F.lit(0.0)) for i in _N]
    return sum((z * z for z in parts), F.lit(0.0))


def _factor(moments: DataFrame) -> DataFrame:
    """(g, m_i, w_ij) of means m_i and covariances c_ij, i >= j, in units of the statistics."""
    df = moments
    for i in _N:  # Cholesky, row by row
        for j in range(i + 1):
            rest = F.col(f"c{i}{j}") - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            df = df.withColumn(f"l{i}{j}", F.sqrt(rest) if i == j else rest / F.col(f"l{j}{j}"))
    for i in _N:  # its inverse
        for j in range(i + 1):
            if i == j:
                value = 1 / F.col(f"l{i}{i}")
            else:
                value = -sum((F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)), F.lit(0.0)) / F.col(f"l{i}{i}")
            df = df.withColumn(f"w{i}{j}", value)
    return df.select("g", *[f"m{i}" for i in _N], *[f"w{i}{j}" for i in _N for j in range(i + 1)])


def estimates(rows: DataFrame, steps: int = STEPS, min_group: int = MIN_GROUP) -> DataFrame:
    """(group, m_i, w_ij): centre and shape of each group's densest ``CORE`` of the rows that pass the base rules.

    Concentration steps from medians and quartiles: the rows nearest to the present centre, by
    the present shape, give the next one, until no group's core changes or ``steps`` are done.
    Distances are ranked in steps of 1/64 of an octave; rows of one step stay together, so a
    core is ``CORE`` of its group or a little more. Groups of fewer than ``min_group`` rows
    share one estimate.
    """
    passing = rows.where(~base_failed()).select("group", *_vector())
    sizes = passing.groupBy("group").agg(F.count("*").alias("n"))
    named = cut(sizes.select("group", F.when(F.col("n") >= min_group, F.col("group")).otherwise(F.lit("")).alias("g")))
    points = cut(passing.join(small(named), "group").select("g", *[f"x{i}" for i in _N]))
    floors = [(SCALE * floor) ** 2 for *_, floor in STATISTICS]
    quartiles = points.groupBy("g").agg(*[F.percentile(f"x{i}", F.array(*map(F.lit, (0.25, 0.5, 0.75)))).alias(f"q{i}") for i in _N])
    start = quartiles.select(
        "g",
        *[F.col(f"q{i}")[1].alias(f"m{i}") for i in _N],
        *[
            (F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, 2) + floors[i] if i == j else F.lit(0.0)).alias(f"c{i}{j}")
            for i in _N
            for j in range(i + 1)
        ],
    )
    # what the covariance of the nearest CORE of a normal sample falls short by
    short = (1 - chi_square_above(chi_square_point(1 - CORE, len(_N)), len(_N) + 2)) / CORE
    params, before = cut(_factor(start)), None
    for _ in range(steps):
        ranked = points.join(small(params), "g").select(
            "g", *[f"x{i}" for i in _N], F.floor(64 * F.log2(_distance() + 1e-3)).cast("int").alias("step")
        )
        edge = ranked.groupBy("g").agg(F.expr(f"percentile_disc({CORE}) within group (order by step)").alias("edge"))
        sums = (
            ranked.join(small(cut(edge)), "g")
            .where("step <= edge")
            .groupBy("g")
            .agg(
                F.count("*").alias("n"),
                *[F.sum(f"x{i}").alias(f"s{i}") for i in _N],
                *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i in _N for j in range(i + 1)],
            )
        )
        mean = lambda i: F.col(f"s{i}") / F.col("n")
        moments = sums.select(
            "g",
            F.xxhash64(*[c for c in sums.columns]).alias("mark"),
            *[mean(i).alias(f"m{i}") for i in _N],
            *[
                ((F.col(f"s{i}{j}") / F.col("n") - mean(i) * mean(j)) / short + (floors[i] if i == j else 0.0)).alias(f"c{i}{j}")
                for i in _N
                for j in range(i + 1)
            ],
        )
        kept = cut(moments)
        mark = kept.agg(F.bit_xor("mark")).first()[0]
        params = cut(_factor(kept))
        if mark == before:
            break
        before = mark
    return cut(named.join(params, "g").drop("g"))


def judged(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with base_failed, distance (squared; null where base_failed) and kept."""
    limit = chi_square_point(TAIL, len(_N))
    both = rows.join(small(found).withColumnRenamed("group", "_group"), F.col("group") == F.col("_group"), "left")
    marked = both.withColumn("base_failed", base_failed()).select("*", *_vector())
    distance = F.when(~F.col("base_failed"), _distance()).alias("distance")
    own = [F.col(c) for c in rows.columns]
    return marked.select(*own, "base_failed", distance).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= limit, F.lit(False))
    )


def quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_cols: tuple[str, ...] = ("lang", "source"),
) -> DataFrame:
    """(doc_id, counts, base_failed, distance, kept): one row per input row.

    A null or empty text has no words and fails the base rules. Null languages and sources form
    groups of their own. Repeated rows are judged alike, each counted. A group whose rows are
    all alike rests on the floors of ``STATISTICS``. Other columns of ``docs`` play no part. No
    rows give no rows.
    """
    rows = cut(counted(docs, id_col, text_col, group_cols))
    return judged(rows, estimates(rows)).select("doc_id", *COUNTS, "base_failed", "distance", "kept")


def keep_good(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_cols: tuple[str, ...] = ("lang", "source"),
) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with their own columns only.

    Counts are taken twice, for the estimates and for the verdicts, so that no text is shuffled.
    """
    found = estimates(cut(counted(docs, id_col, text_col, group_cols)))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = counted(whole, "row", f"row.{text_col}", tuple(f"row.{c}" for c in group_cols))
    return judged(rows, found).where("kept").select("doc_id.*")
