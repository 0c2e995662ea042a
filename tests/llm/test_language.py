"""Language identification: sums over segmentations by brute force, held-out accuracy, edge cases."""

import random
import zlib

import numpy as np
import pytest

from siftwork.llm import unigram_language as ul

FILE = "piece_bpe_32k.model"


def all_cuts(word, vocab):
    """Every way to cut a marked word into pieces."""
    if not word:
        yield []
        return
    for n in range(1, len(word) + 1):
        piece = vocab.pieces.get(word[:n], 0 if n == 1 else None)
        if piece is not None:
            for rest in all_cuts(word[n:], vocab):
                yield [piece, *rest]


@pytest.fixture(scope="module")
def weights():
    w = np.random.default_rng(3).random((ul.vocabulary(FILE).size, 3))
    return w / w.sum(axis=0)


def test_forward_sums_all_segmentations(weights):
    vocab = ul.vocabulary(FILE)
    words = ["the", "a", "straße", "éclair", "ꙮx", "nnnn", "there"]
    got = ul.log_likelihoods(words, vocab, weights)
    for word, logs in zip(words, got):
        plain = sum(np.prod(weights[cut], axis=0) for cut in all_cuts(ul.BEGIN + word, vocab))
        assert np.allclose(logs, np.log(plain))
        assert np.allclose(ul.long_word(word, vocab, weights), np.log(plain))


def test_expected_uses(weights):
    vocab = ul.vocabulary(FILE)
    words, times = ["there", "ꙮx"], np.array([3.0, 2.0])
    plain = np.zeros(vocab.size)
    for word, n in zip(words, times):
        cuts = [(cut, np.prod(weights[cut, 0])) for cut in all_cuts(ul.BEGIN + word, vocab)]
        whole = sum(p for _, p in cuts)
        for cut, p in cuts:
            for piece in cut:
                plain[piece] += n * p / whole
    got = ul.expectations(words, times, vocab, np.ascontiguousarray(weights[:, 0]))
    assert np.allclose(got / ul.UNIT, plain, atol=1e-4)


def test_words():
    assert ul.words_of("Don't ½ 12 x² Straße") == {"don": 1, "t": 1, "x²": 1, "straße": 1}
    assert ul.words_of(None) == ul.words_of("12 ½ ²") == {}


def corpus(spark, n=400):
    rng = random.Random(8)
    sounds = {"aa": ["ta", "lo", "mi", "ver"], "bb": ["sch", "ung", "ein", "ta"], "cc": ["eau", "oi", "que", "lo"]}
    rows = []
    for i in range(n):
        lang = rng.choice(list(sounds))
        text = " ".join("".join(rng.choice(sounds[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(3, 30)))
        rows.append((i, text, lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), {i: x for i, _, x in rows}


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_held_out_accuracy_and_partitions(spark):
    df, truth = corpus(spark)
    model = ul.fit(df.repartition(1))
    got = {r.doc_id: r for r in ul.identify(df, model).collect()}
    assert len(got) == 400 and all(r.held_out == held(i) for i, r in got.items())
    out = [i for i in got if held(i)]
    assert np.mean([got[i].lang_pred == truth[i] for i in out]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())
    other = ul.fit(df.repartition(7, "text"))
    assert other.languages == model.languages and (other.weights == model.weights).all()


def test_model_equals_plain_rounds(spark):
    df, _ = corpus(spark, 60)
    model, vocab = ul.fit(df, rounds=2), ul.vocabulary(FILE)
    assert model.weights.shape == (vocab.size, 3) and np.allclose(model.weights.sum(axis=0), 1)
    start = np.full(vocab.size, 1e-6)
    for p, i in vocab.pieces.items():
        start[i] = 30.0 ** -len(p.removeprefix(ul.BEGIN))
    w = start / start.sum()
    words = ul.Counter()
    for r in df.collect():
        if r.lang == "aa" and not held(r.doc_id):
            words.update(ul.words_of(r.text))
    for _ in range(2):
        used = np.full(vocab.size, 0.1)
        for word, n in words.items():
            if len(word) > 9:
                used += ul.expectations([word], np.array([float(n)]), vocab, w) / ul.UNIT
                continue
            cuts = [(c, np.prod(w[c])) for c in all_cuts(ul.BEGIN + word, vocab)]
            whole = sum(p for _, p in cuts)
            for c, p in cuts:
                np.add.at(used, c, n * p / whole)
        w = used / used.sum()
    assert np.allclose(model.weights[:, 0], w, atol=1e-6)


def test_held_out_rows_and_other_columns_are_not_learnt_from(spark):
    df, _ = corpus(spark, 80)
    model = ul.fit(df)
    from pyspark.sql import functions as F

    spoilt = df.withColumn("lang", F.when(ul.fold_of("doc_id") == 0, F.lit("zz")).otherwise(F.col("lang"))).withColumn("word", F.lit(1)).withColumn("id", F.lit("x"))
    again = ul.fit(spoilt)
    assert again.languages == model.languages and (again.weights == model.weights).all()
    assert len(ul.identify(spoilt, again).collect()) == 80


def test_edge_cases(spark):
    df, _ = corpus(spark, 80)
    model = ul.fit(df)
    odd = [(1, None), (2, ""), (3, "123 ½ !?"), (4, "eauoi"), (4, "schung"), (None, "taque"), (5, "eauoi" * 20_000), (6, "ꙮ" * 3000), (7, "eau oi que " * 100_000)]
    rows = ul.identify(spark.createDataFrame(odd, "doc_id long, text string"), model).collect()
    assert len(rows) == len(odd)
    got = [(r.doc_id, r.lang_pred) for r in rows if r.doc_id is not None]
    assert got.count((1, "und")) == got.count((2, "und")) == got.count((3, "und")) == 1
    assert (4, "cc") in got and (4, "bb") in got and (5, "cc") in got and (7, "cc") in got
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    assert ul.identify(spark.createDataFrame([], "doc_id long, text string"), model).collect() == []


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "abc", None), (None, "abc", "en")], "doc_id long, text string, lang string")
    model = ul.fit(df)
    assert {(r.lang_pred, r.score) for r in ul.identify(df, model).collect()} == {("und", 0.0)}
