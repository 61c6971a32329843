import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from creditspark.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(PATH)
OWN = packing.WordIds(PATH)
PARTS = [" ", "\n", "\x1c", "\x85", "　", "'ll", "the", "The.", "ΑΣ", "İ", "é", "Å", "12", "!!", "a,b", "<|endoftext|>", "<|ENDOFTEXT|>", "日本", "́"]


def lib(text):
    return LIB.encode(text, add_special_tokens=False).ids


@given(st.lists(st.sampled_from(PARTS) | st.text(max_size=4), max_size=12).map("".join))
@settings(max_examples=400, deadline=None)
def test_ids_are_the_library_s(text):
    assert np.frombuffer(OWN.ids(text), "<u4").tolist() == lib(text)


def check(texts, rows, capacity):
    """Each document's pieces in order and whole; each sequence gapless and within capacity."""
    want = []
    for doc_id, text in texts:
        ids = np.array([*lib(text or ""), 0], "<u4")
        for i, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want.append((doc_id, i, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted(map(repr, (tuple(r)[:5] for r in rows))) == sorted(map(repr, want))
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held), -(-sum(w[3] for w in want) // capacity)


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    used, least = check(texts, packing.pack_documents(docs).collect(), 2048)
    assert used <= 1.02 * least + 1


def test_hard_rows(spark):
    rng = random.Random(1)
    long = " ".join(rng.choice(["ab", "cd.", "THE", "x!!"]) for _ in range(9000))
    texts = [(1, None), (2, ""), (3, long), (4, "same"), (4, "same"), (None, "none"), (5, "word " * 40)] + [(6, "one")] * 50
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("length", F.lit("x")).withColumn("part", F.lit(1))
    check(texts, packing.pack_documents(df).collect(), 2048)
    check(texts, packing.pack(packing.pieces(df, capacity=64), 64, 8, rank_rows=3).collect(), 64)
    assert packing.pack_documents(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_layout_takes_every_piece_once_and_stays_close_to_best_fit(seed):
    rng = np.random.default_rng(seed)
    lengths = np.clip(rng.gamma(0.5 + seed / 2, 300, 20_000).astype(int) + 1, 1, 2048)
    counts = {int(n): int(c) for n, c in zip(*np.unique(lengths, return_counts=True))}
    layout = packing.lay_out(counts)
    placed = dict.fromkeys(counts, 0)
    used = {}
    for length, rank, sequences, each, base, offset in sorted(layout.segments):
        assert rank == placed[length]
        placed[length] += sequences * each
        for s in range(base, base + sequences):
            used.setdefault(s, []).extend((offset + i * length, length) for i in range(each))
    assert placed == counts and len(used) == layout.sequences
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(used) <= 1.01 * (lengths.sum() / 2048) + 1


def test_nnls_conditions():
    rng = np.random.default_rng(0)
    a, b = rng.random((20, 60)), rng.random(20)
    x = packing.nnls(a, b)
    gradient = a.T @ (b - a @ x)
    assert (x >= 0).all() and gradient.max() < 1e-6 and abs(gradient[x > 0]).max(initial=0) < 1e-6
