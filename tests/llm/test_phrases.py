"""Phrase mining against a plain count of all word sequences."""

import collections
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa

from siftwork.llm import setm_phrases


def brute(rows, least, most_words, share, top):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, most_words + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        good = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in good.items():
            longer = [q for q, b in good.items() if len(q) > len(p) and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if longer:
                continue
            score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(t, x, 1) for t, x in rows], "text string, lang string, id int")


def mined(df, **more):
    return sorted(tuple(r) for r in setm_phrases.phrases(df, **more).collect())


def sample(seed, n):
    rng = random.Random(seed)
    words = ["a", "B", "É", "ab", "Zz", "x\x00y", "\xa0", "c", "d-e"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "\r", "!"]
    rows = [("".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(0, 60))), rng.choice(["en", "en", "fr", None])) for _ in range(n)]
    return rows + [(None, "en"), ("", None), ("  \t", "xx"), ("lone", "yy")]


def test_all_phrases_and_ranks(spark):
    rows = sample(1, 300)
    assert mined(frame(spark, rows).repartition(5), min_count=12, top=40) == brute(rows, 12, 4, 80, 40)


def test_longer_phrases_take_their_parts_along(spark):
    rows = [("one two three four five. one two", "en")] * 30 + [("two three", "en")] * 6 + [("three four", "en")] * 20
    got = mined(frame(spark, rows))
    assert got == brute(rows, 30, 4, 80, 2000)
    # f(two three) = 36 and f(one two three) = 30: covered.  f(three four) = 50: not.
    assert "two three" not in {r[2] for r in got} and "three four" in {r[2] for r in got}


def test_blocks_do_not_change_the_result(spark):
    rows = sample(2, 200)
    whole = mined(frame(spark, rows).coalesce(1), min_count=8)
    found = setm_phrases.Block()
    found.add(["a b a", "b"])
    assert found.size > 0 and [len(f) for f in found.rows(1, "en")] == [2, 1]
    assert mined(frame(spark, rows).repartition(7), min_count=8) == whole == brute(rows, 8, 4, 80, 2000)


def test_other_lengths(spark):
    rows = sample(3, 150)
    assert mined(frame(spark, rows), min_count=6, max_words=2, top=None) == brute(rows, 6, 2, 80, None)
    assert mined(frame(spark, rows), min_count=6, max_words=5, inside_share=50) == brute(rows, 6, 5, 50, 2000)


def test_very_long_text_and_one_phrase_everywhere(spark):
    rows = [(" ".join(["hot pair"] * 60_000), "en")] + [("hot pair " * 20, "en")] * 200
    got = mined(frame(spark, rows))
    n = 120_000 + 200 * 40
    assert got == brute(rows, 30, 4, 80, 2000)
    assert [(r[2], r[3], r[6]) for r in got] == [("hot pair hot pair", 59_999 + 200 * 19, n), ("pair hot pair hot", 59_998 + 200 * 18, n)]


def test_score_of_huge_counts(spark):
    from pyspark.sql import functions as F

    a, both = 9_000_000_000_000_000, 10_000_000_000_000_001
    row = spark.range(1).select(setm_phrases.floor_score(F.lit(a), F.lit(both)).alias("s")).first()
    assert row.s == 2_000_000 * a // both


def test_empty_table_and_clashing_columns(spark):
    assert mined(frame(spark, []).where("id = 0")) == []
    rows = [("a b", "en")] * 40
    odd = spark.createDataFrame([(t, x, 5, "z", 7) for t, x in rows], "text string, lang string, block int, word string, f long")
    assert mined(odd) == brute(rows, 30, 4, 80, 2000)


def test_pairs_of_a_block_are_numbered_in_little_memory():
    rng = np.random.default_rng(3)
    for size in (50, 3_000_000_000):
        first, second = (rng.integers(0, 50, 4000) * (size // 50) for _ in "ab")
        pairs, number, times = setm_phrases.numbered(first, second, size)
        known, place, counts = np.unique(first * size + second, return_inverse=True, return_counts=True)
        assert np.array_equal(pairs, known) and np.array_equal(number, place) and np.array_equal(times, counts)
    first, second = rng.integers(0, 3000, (2, 400_000)).astype(np.int32)
    tracemalloc.start()
    setm_phrases.numbered(first, second, 3000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50 * len(first)  # np.unique takes 72


def test_groups_of_a_block_travel_in_chunks():
    wide = np.arange(250_000)
    got = setm_phrases.groups_table(pa.scalar(7), wide, wide + 1, wide + 2)
    assert max(x.num_rows for x in got.to_batches()) <= setm_phrases.CHUNK < got.num_rows == 250_000
    assert got["place"].to_pylist() == [(7 << setm_phrases.CODES) + i for i in range(250_000)]
    assert setm_phrases.groups_table(pa.scalar(7), wide[:0], wide[:0], wide[:0]).num_rows == 0
