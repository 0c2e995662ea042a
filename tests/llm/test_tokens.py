"""Token ids, prefix counts and packing against the tokenizer library."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwork.llm import curve_packing, prefix_tokens
from siftwork.llm.tokens import byte_tokenizer, tokenizer_path

LETTERS = " \n\t '’sredvtlmABé1²½_!$.　 \x1c中字🙂"


@pytest.fixture(scope="module")
def tokenizer():
    return byte_tokenizer(tokenizer_path())


def texts(n, seed):
    rng = random.Random(seed)
    out = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 14))) for _ in range(n)]
    return [t + "<|endoftext|>" + t[:3] if i % 7 == 0 else t for i, t in enumerate(out)]


def test_ids_equal_the_library(tokenizer):
    for t in texts(4000, 1):
        assert tokenizer.ids(t).tolist() == tokenizer.library.encode(t, add_special_tokens=False).ids, repr(t)


def test_prefix_counts_equal_encoding_every_prefix(tokenizer):
    table = prefix_tokens.PrefixTable(tokenizer)
    for t in texts(600, 2):
        brute = [len(tokenizer.library.encode(t[:p], add_special_tokens=False).ids) for p in range(len(t) + 1)]
        assert table.prefixes(t).tolist() == brute, repr(t)
        assert table.tokens(t) == brute[-1]


def test_memory_limit_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(prefix_tokens, "MEMORY", 8)
    table = prefix_tokens.PrefixTable(tokenizer)
    for t in texts(50, 3):
        assert table.tokens(t) == len(tokenizer.library.encode(t, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def odd(spark):
    long = "word 123, don't stop.\n" * 20_000
    rows = [(1, "a b", "x"), (1, "a b", "x"), (2, None, None), (3, "", "y"), (None, "c", "z"), (4, long, "w")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")


def test_counts_of_odd_rows(spark, odd, tokenizer):
    got = prefix_tokens.token_counts(odd)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    rows = sorted(map(tuple, got.collect()), key=str)
    expected = []
    for r in odd.collect():
        text = r.text or ""
        n = len(tokenizer.library.encode(text, add_special_tokens=False).ids)
        expected.append((r.doc_id, len(text.encode()), n, n > 1024))
    assert rows == sorted(expected, key=str)
    assert prefix_tokens.token_counts(odd.limit(0)).count() == 0


def test_other_kinds_of_files(spark, odd):
    import sentencepiece

    for name in ("piece_bpe_32k.model", "word_bpe_49k.json"):
        got = {(r.doc_id, r.n_bytes): r.n_tokens for r in prefix_tokens.token_counts(odd, tokenizer=name).collect()}
        path = tokenizer_path(name)
        if name.endswith(".model"):
            brute = len(sentencepiece.SentencePieceProcessor(model_file=path).encode("a b"))
        else:
            brute = len(byte_tokenizer(path).library.encode("a b", add_special_tokens=False).ids)
        assert got[1, 3] == brute


def test_budget_question(spark, tokenizer):
    rows = spark.createDataFrame([(1, "The cat doesn't sit.  Now"), (2, None)], "doc_id long, text string")
    tables = prefix_tokens.prefix_tables(rows)
    for budget in (0, 3, 100):
        got = {r.doc_id: r.fitting_chars for r in prefix_tokens.longest_within(tables, budget).collect()}
        text = "The cat doesn't sit.  Now"
        fits = [p for p in range(len(text) + 1) if len(tokenizer.library.encode(text[:p], add_special_tokens=False).ids) <= budget]
        assert got == {1: max(fits), 2: 0}


def test_hilbert_neighbours_touch():
    side = 8
    cells = np.array([(a, b, c) for a in range(side) for b in range(side) for c in range(side)])
    keys = curve_packing.hilbert_keys(cells, bits=3)
    assert sorted(keys) == list(range(side**3))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check_packing(spark, df, tokenizer, capacity=2048):
    pieces = [r.asDict() for r in curve_packing.pack(df, capacity=capacity).collect()]
    documents = sorted(
        (str(r.doc_id), np.array(tokenizer.library.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4").tobytes()) for r in df.collect()
    )
    sequences = {}
    for p in pieces:
        assert zlib.crc32(p["ids"]) == p["ids_crc32"] and len(p["ids"]) == 4 * p["length"]
        sequences.setdefault(p["sequence_id"], []).append(p)
    stream = b""
    rebuilt = {}
    for number in sorted(sequences):
        at = 0
        for p in sorted(sequences[number], key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
            stream += p["ids"]
            rebuilt.setdefault((str(p["doc_id"]), p["doc_tokens"]), []).append((p["start"], p["ids"]))
        assert at <= capacity and (at == capacity or at & (at - 1) == 0)
    assert len(stream) == sum(len(b) for _, b in documents)
    return rebuilt, documents


def test_packing_round_trip(spark, sf_dir, tokenizer):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rebuilt, documents = check_packing(spark, df, tokenizer)
    got = sorted((key, b"".join(ids for _, ids in sorted(parts))) for (key, _), parts in rebuilt.items())
    assert got == documents


def test_packing_odd_rows(spark, odd, tokenizer):
    df = odd.withColumn("sequence_id", F.lit("clash"))
    check_packing(spark, df, tokenizer, capacity=64)
    assert curve_packing.pack(odd.limit(0)).count() == 0
