import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from creditspark.llm.token_counts import PrefixCounts, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)
OWN = PrefixCounts(PATH)


def lib(text):
    return len(LIB.encode(text, add_special_tokens=False).ids)


PARTS = [" ", "  ", "\n", "\n\n", "\t ", "　", "\x1c", "'ll", "'re", "'s", "'", "the", "tion", "é", "日本", "12", "3", "!!", "=====", "aaa", "<|endoftext|>", "<|endo", "é", "ΑΣ", "😀"]


@given(st.lists(st.sampled_from(PARTS) | st.text(max_size=4), max_size=12).map("".join))
@settings(max_examples=400, deadline=None)
def test_every_prefix_of_odd_texts(text):
    assert OWN.prefixes(text) == [lib(text[:i]) for i in range(len(text) + 1)]
    assert OWN.count(text) == lib(text)
    best = [max(i for i in range(len(text) + 1) if lib(text[:i]) <= n) for n in (0, 1, 3, 6)]
    assert OWN.measure(text, (0, 1, 3, 6)) == (lib(text), *best)


def test_whole_table_against_the_library(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = token_counts(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_bytes, r.n_tokens) == (len(texts[r.doc_id].encode()), lib(texts[r.doc_id]))
        assert lib(texts[r.doc_id][: r.fit_1024]) <= 1024
        assert r.fit_1024 == len(texts[r.doc_id]) or lib(texts[r.doc_id][: r.fit_1024 + 1]) > 1024


def test_hard_rows(spark):
    rng = random.Random(3)
    long = "".join(rng.choice(PARTS) for _ in range(60_000))
    run = "x" * 20_000 + "=" * 20_000
    rows = [(1, None), (2, ""), (3, " "), (4, long), (5, run), (5, run), (None, "a b"), (6, "<|endoftext|>")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("x"))
    got = token_counts(df, limits=(0, 5), prefixes=True).collect()
    assert [(r.doc_id, r.n_tokens) for r in got] == [(i, lib(t or "")) for i, t in rows]
    assert all(r.prefix_tokens[-1] == r.n_tokens and len(r.prefix_tokens) == len(t or "") + 1 for r, (_, t) in zip(got, rows))
    assert token_counts(df.limit(0)).count() == 0


@pytest.mark.parametrize("size", [300])
def test_each_character_between_letters(size):
    chars = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(chars), size):
        text = "".join(f"a{c} b {c}c" for c in chars[at : at + size])
        assert OWN.count(text) == lib(text)
