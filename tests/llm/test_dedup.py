"""Near duplicates and repeated passages against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwork.llm import bag_minhash, epsilon_grid, recompression, suffix_dedup, windows
from siftwork.llm.components import connected

WORD = re.compile("[^\x20\x09-\x0d]+")


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(40, 90)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)] + [(5, 5)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == roots(linked, [x for x in links if x[0] != x[1]])
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def bag(text):
    words = WORD.findall(text or "")
    if 0 < len(words) < 5:
        return collections.Counter([tuple(words)])
    return collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_groups(texts, threshold=0.8):
    bags = [bag(t) for t in texts]
    links = []
    for i in range(len(texts)):
        for j in range(i):
            both = sum((bags[i] & bags[j]).values())
            either = sum(bags[i].values()) + sum(bags[j].values()) - both
            if either == 0 or both >= threshold * either:
                links.append((i, j))
    return roots(range(len(texts)), links)


def variants(seed=2):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    texts = [None, "", " \n", "one two", "one  two", "one two three four five six"]
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 5)):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    return texts + ["x y z w v " * 30, "x y z w v " * 28, "x y z w v " * 10]


def test_near_duplicates_by_brute_force(spark):
    texts = variants()
    df = spark.createDataFrame([(i, t, "g") for i, t in enumerate(texts)], "doc_id long, text string, group_id string")
    got = {r.doc_id: r for r in bag_minhash.near_duplicates(df).collect()}
    expected = brute_groups(texts)
    assert {i: r.group_id for i, r in got.items()} == expected
    assert all(r.kept == (i == r.group_id) for i, r in got.items())
    kept = bag_minhash.one_of_each(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(expected.values()))


def test_links_across_components_of_a_bucket(spark):
    """A chain of edits: most members are far from any one leader and linked only to their neighbours."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    text = [rng.choice(words) for _ in range(150)]
    texts = [" ".join(text)]
    for i in range(60):
        text[(i * 7) % 150] = rng.choice(words)
        texts.append(" ".join(text))
    for _ in range(60):
        text = texts[0].split()
        for _ in range(rng.randint(1, 15)):
            text[rng.randrange(150)] = rng.choice(words)
        texts.append(" ".join(text))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.group_id for r in bag_minhash.near_duplicates(df).collect()}
    assert got == brute_groups(texts)


def test_near_duplicates_of_odd_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "only here without id at all"), (2, None), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, bag_minhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 1, 1, True)] * 2 + [(None, 1, 1, False), (None, None, None, True)] + [(2, 2, 2, True)] * 2, key=str)
    assert bag_minhash.near_duplicates(df.limit(0)).count() == 0


def test_small_blocks_find_the_same_links(spark, monkeypatch):
    """Blocks of three texts, a large and a small leader, texts of very different sizes in one bucket."""
    monkeypatch.setattr(bag_minhash, "BLOCK", 3)
    test_links_across_components_of_a_bucket(spark)
    test_near_duplicates_by_brute_force(spark)


def test_overlaps_of_many_texts_at_once():
    rng = random.Random(8)
    lists = [[rng.choice("abc") for _ in range(rng.choice([0, 3, 5, 40]))] for _ in range(40)]
    owner, value, count = bag_minhash.shingles(lists)
    cut = np.searchsorted(owner, np.arange(41))
    bags = [(value[s:e], count[s:e]) for s, e in zip(cut, cut[1:])]
    both = bag_minhash.overlaps(bags[:15], bags[15:])
    for i in range(15):
        for j in range(25):
            a, b = (dict(zip(*map(np.ndarray.tolist, x))) for x in (bags[i], bags[15 + j]))
            assert both[i, j] == sum(min(n, b.get(v, 0)) for v, n in a.items())


def test_exactly_one_row_of_a_group_stays(spark):
    """Rows ingested twice, equal ids with different texts, groups without ids, clashing names."""
    body = "one two three four five six seven eight nine ten"
    rows = [(1, body), (1, body), (1, body + " "), (2, body), (None, "alpha beta gamma delta eps"), (None, "alpha beta gamma delta eps"), (3, None), (3, "")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, root int, node string")
    kept = bag_minhash.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted([(r.doc_id, (r.text or "").strip()) for r in kept.collect()], key=str) == sorted([(1, body), (None, "alpha beta gamma delta eps"), (3, "")], key=str)


def test_signatures_are_unbiased():
    rng = np.random.default_rng(0)
    values = rng.integers(1, 2**63, 40).astype(np.uint64)
    a, b = rng.integers(1, 20, 40), rng.integers(1, 20, 40)
    jaccard, equal = np.minimum(a, b).sum() / np.maximum(a, b).sum(), []
    for k in range(60):
        v = np.sort(bag_minhash.mix64(values + np.uint64(k * 1000003)))
        s = bag_minhash.signatures(np.repeat([0, 1], 40), np.concatenate([v, v]), np.concatenate([a, b]), 2)
        equal.append((s[0] == s[1]).mean())
    assert abs(np.mean(equal) - jaccard) < 4 * np.std(equal) / 60**0.5


def brute_bytes(rows, length=50):
    first = {}
    for key, data in sorted(rows):
        for p in range(len(data) - length + 1):
            first.setdefault(data[p : p + length], key)
    out = []
    for key, data in rows:
        cover = np.zeros(len(data) + 1, int)
        for p in range(len(data) - length + 1):
            if first[data[p : p + length]] < key:
                cover[p] += 1
                cover[p + length] -= 1
        gone = np.append(False, np.cumsum(cover[:-1]) > 0)
        kept = bytes(b for b, g in zip(data, gone[1:]) if not g)
        out.append((len(data), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def passages(seed):
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abc é") for _ in range(rng.randint(40, 120))) for _ in range(6)] + ["ab" * 60, "a" * 130]
    texts = []
    for _ in range(40):
        parts = ["".join(rng.choice("abcdefgh \n") for _ in range(rng.randint(0, 60))) for _ in range(3)]
        texts.append(parts[0] + rng.choice(shared) + parts[1] + rng.choice(shared) + parts[2])
    return [*texts, texts[0], texts[0], "", None, "short", "z" * 49, "z" * 50, "z" * 60]


def test_repeated_bytes_by_brute_force(spark):
    texts = passages(4)
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(k, t, "n") for k, t in rows], "doc_id long, text string, n_bytes string").repartition(5)
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(df).collect()}
    expected = brute_bytes([(k, (t or "").encode()) for k, t in rows])
    for (key, text), e in zip(rows, expected):
        r = got[key]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == e, key
        assert hashlib.sha256(r.kept).hexdigest() == e[3] and sum(b - a for a, b in r.removed) == e[1]


def test_repeated_bytes_of_odd_rows(spark):
    a, b = "q" * 20 + "the passage that all of these rows have in common, word for word", "another text " * 6
    rows = [(1, a), (1, a), (1, b + a), (None, a), (None, a), (2, a), (3, b)]
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed) for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    n, m = len(a), len(b)
    assert got == sorted([(1, n, 0), (1, n, 0), (1, n + m, 0), (None, n, n), (None, n, n), (2, n, n), (3, m, m)], key=str)
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_suffix_order_survives_collisions(monkeypatch):
    data = np.frombuffer(("ab" * 60 + "abc" * 40 + "a" * 90 + "xyz" * 30).encode(), np.uint8)
    size = 20
    count = len(data) - size + 1

    class Weak(suffix_dedup.PrefixHashes):
        def of(self, start, size):
            return super().of(start, size) & np.uint64(3)

    for kind in (suffix_dedup.PrefixHashes, Weak):
        monkeypatch.setattr(suffix_dedup, "PrefixHashes", kind)
        order, new = suffix_dedup.SuffixOrder(data, size).classes(np.arange(count), np.zeros(count, int), np.full(count, count))
        texts = [data[p : p + size].tobytes() for p in order]
        if kind is Weak:
            classes = np.cumsum(new)
            assert all(len({t for t, c in zip(texts, classes) if c == k}) == 1 for k in set(classes))
        else:
            assert texts == sorted(texts) and new.sum() == len(set(texts))


def test_one_of_equal_suffixes_is_sorted(monkeypatch):
    """Groups of many equal suffixes among a few others: the sort sees one of each, the order and the classes are those of all."""
    rng = random.Random(5)
    parts = ["".join(rng.choice("ab") for _ in range(12)) + "x" * 70 for _ in range(6)] + ["ab" * 41]
    texts = [rng.choice(parts) for _ in range(300)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    start = np.arange(300) * 82
    size = np.repeat([100, 1, 199], [100, 1, 199])
    begin = np.repeat([0, 100, 101], [100, 1, 199])
    seen = []
    kept = suffix_dedup.SuffixOrder.sort
    monkeypatch.setattr(suffix_dedup.SuffixOrder, "sort", lambda self, order, *rest: (seen.append(len(order)), kept(self, order, *rest))[1])
    for length in (50, 75):
        order, new = suffix_dedup.SuffixOrder(data, length).classes(start, begin, size)
        got = [data[p : p + length].tobytes() for p in order]
        groups = [slice(0, 100), slice(100, 101), slice(101, 300)]
        for g in groups:
            assert got[g] == sorted(data[p : p + length].tobytes() for p in start[g])
            assert new[g].tolist() == [True, *[a != b for a, b in zip(got[g], got[g][1:])]]
        assert seen.pop() == sum(len(set(got[g])) for g in groups if g.stop - g.start > 1) <= 14


def test_every_room_has_its_partition(spark):
    rooms = windows.dealt(spark.range(24).selectExpr("int(id) AS room"), 24).selectExpr("room", "spark_partition_id() AS part")
    assert sorted((r.room, r.part) for r in rooms.collect()) == [(i, i) for i in range(24)]


def brute_words(texts, length=35):
    lists = [WORD.findall(t or "") for t in texts]
    count = collections.Counter(tuple(w[i : i + length]) for w in lists for i in range(len(w) - length + 1))
    out = []
    for w in lists:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if count[tuple(w[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        out.append((len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return out


def word_texts(seed, letters):
    rng = random.Random(seed)
    words = [rng.choice(letters) * rng.randint(1, 2) for _ in range(12)]

    def some(n):
        return [rng.choice(words) for _ in range(n)]

    shared = [some(rng.randint(30, 80)) for _ in range(4)] + [["same"] * 90, ["p", "q"] * 50]
    texts = [" ".join(some(rng.randint(0, 50)) + rng.choice(shared) + some(rng.randint(0, 50)) + rng.choice(shared)) for _ in range(30)]
    return [*texts, texts[1], "", None, "a b", " ".join(shared[0] + shared[0]), "x\xa0y " * 40]


@pytest.mark.parametrize("letters", ["ab", "abcdefghijkl"])
def test_repeated_words_by_brute_force(spark, letters):
    texts = word_texts(5, letters)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in recompression.remove_repeats(df).collect()}
    for i, e in enumerate(brute_words(texts)):
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == e, i


def test_repeated_words_of_odd_rows(spark, monkeypatch):
    long = " ".join(f"w{i % 97}x{i % 89}" for i in range(3000))
    monkeypatch.setattr(recompression, "CHUNK", 100)
    rows = [(1, long), (None, long), (1, "a b c"), (2, None)]
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in recompression.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted([("1", 3000, 3000), ("None", 3000, 3000), ("1", 3, 0), ("2", 0, 0)])
    assert recompression.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def few_of_a_key(kind, most):
    """``kind``, refusing frames with more than ``most`` contexts of one key."""

    def made(length):
        judge = kind(length)

        def run(frame):
            assert frame["key"].value_counts().max() <= most
            return judge(frame)

        return run

    return made


@pytest.mark.parametrize("gather", [50_000, 7])
def test_a_passage_in_differing_surroundings_is_split_by_window(spark, monkeypatch, gather):
    """At the edges of a shared passage one key has a context of its own per document; no task may hold them all."""
    monkeypatch.setattr(windows, "HOT", 8, raising=False)
    monkeypatch.setattr(windows, "GATHER", gather)
    monkeypatch.setattr(suffix_dedup, "judge_bytes", few_of_a_key(suffix_dedup.judge_bytes, 8))
    monkeypatch.setattr(recompression, "judge_words", few_of_a_key(recompression.judge_words, 8))
    rng = random.Random(9)

    def some(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))

    passage, tails = some(45), [some(30) for _ in range(4)]
    texts = [" ".join([some(40), passage, rng.choice(tails), some(40)]) for _ in range(60)] + ["", None, passage, some(50)]
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(df).collect()}
    for (key, _), e in zip(rows, brute_bytes([(k, (t or "").encode()) for k, t in rows])):
        assert (got[key].n_bytes, got[key].n_removed, got[key].n_spans, got[key].kept_sha256) == e, key
    got = {r.doc_id: r for r in recompression.remove_repeats(df).collect()}
    for (key, _), e in zip(rows, brute_words(texts)):
        assert (got[key].n_words, got[key].n_removed, got[key].kept_sha256) == e, key


def test_the_same_share_of_contexts_is_split_by_window_at_every_size(spark, monkeypatch):
    """With a fixed number, keys of a larger table pass it one after the other, and what is split grows faster than the table."""
    monkeypatch.setattr(windows, "HOT", 5)
    monkeypatch.setattr(windows, "HOT_SHARE", 20, raising=False)

    def split(times):
        sizes = [(k, k * times) for k in range(1, 13)]
        found = spark.createDataFrame(sizes, "key long, n int").selectExpr("key", "explode(sequence(1, n)) AS i").selectExpr("key", "xxhash64(key, i) AS mark")
        return sorted(r.key for r in windows.hot_keys(found).collect())

    assert split(2) == split(20) == list(range(4, 13))


def test_answers_are_written_before_they_meet_the_contexts(spark):
    """So the shuffles that led to them can go first."""
    judge, split = suffix_dedup.judge_bytes(50), suffix_dedup.byte_windows(50)
    rows = [(1, 10 + i, 20 + i, 0, 0, bytearray(b"x" * (50 + i)), i) for i in range(3)]
    found = spark.createDataFrame(rows, "key long, id long, print long, start int, lead int, body binary, mark long")
    assert windows.judged(found, judge, split, 4).inputFiles()


def test_interior_symbols_depend_on_the_window_alone():
    rng = np.random.default_rng(6)
    window = recompression.mix64(rng.integers(0, 6, 35).astype(np.uint64))
    seen = set()
    for _ in range(50):
        left, right = (recompression.mix64(rng.integers(0, 6, rng.integers(0, 40)).astype(np.uint64)) for _ in range(2))
        place, key = recompression.representatives(np.concatenate([left, window, right]), np.zeros(len(left) + 35 + len(right), int), 35)
        seen.add((int(place[len(left)]) - len(left), int(key[len(left)])))
    assert len(seen) == 1


def brute_vectors(rows, threshold=0.95):
    good = {}
    for i, (key, v) in enumerate(rows):
        v = np.array([np.nan if x is None else x for x in v], float) if v is not None else np.empty(0)
        if len(v) and np.isfinite(v).all() and v.any():
            good[i] = v / np.abs(v).max()
    size = max(map(len, good.values()), default=0)
    good = {i: np.append(v, np.zeros(size - len(v))) for i, v in good.items()}
    links = [(i, j) for i in good for j in good if j < i and good[i] @ good[j] / np.sqrt((good[i] @ good[i]) * (good[j] @ good[j])) >= threshold]
    count = collections.Counter(x for pair in links for x in pair)
    root = roots(range(len(rows)), links)
    return [(key, count[i], rows[root[i]][0], root[i] == i) for i, (key, _) in enumerate(rows)]


@pytest.mark.parametrize("block", [4, 2048])
def test_near_vectors_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(epsilon_grid, "BLOCK", block)
    rng = np.random.default_rng(7)
    rows = []
    for _ in range(25):
        base = rng.standard_normal(8)
        rows += [(base + rng.standard_normal(8) * rng.choice([0, 0.05, 0.1, 0.15])).tolist() for _ in range(rng.integers(1, 6))]
    rows += [rows[0], rows[0], (np.array(rows[0]) * 3).tolist(), None, [], [0.0] * 8, [1.0, None] * 4, [float("nan")] * 8, [float("inf")] * 8, [1.0, 2.0], [1e300, 2e300], [1e-300, 2e-300]]
    rows = [(i, v) for i, v in enumerate(rows)]
    df = spark.createDataFrame([(k, v, 1) for k, v in rows], "vec_id long, embedding array<double>, n_links int").repartition(3)
    got = sorted(map(tuple, epsilon_grid.near_vectors(df).collect()))
    assert got == brute_vectors(rows)


def test_near_vectors_of_odd_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.01]), (None, None)], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, epsilon_grid.near_vectors(df).collect()), key=str)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 0, None, True)], key=str)
    assert epsilon_grid.near_vectors(df.limit(0)).count() == 0
    assert epsilon_grid.near_vectors(df.where("embedding IS NULL")).count() == 1


def test_equal_byte_windows_have_equal_anchors(monkeypatch):
    """Over chunk borders and batches, empty and short texts; the powers behind the hashes are made once."""
    rng = random.Random(12)
    passage = "".join(rng.choice("ab") for _ in range(130))
    texts = ["", passage, "x", *["".join(rng.choice("ab") for _ in range(rng.randint(0, 90))) + passage + "é" * rng.randint(0, 60) for _ in range(40)], "", passage[:49], ""]
    monkeypatch.setattr(suffix_dedup, "CHUNK", 200)
    before = suffix_dedup.powers.cache_info()
    find = suffix_dedup.byte_anchors(50)
    found = list(zip(*(x.tolist() for x in find(texts))))
    after = suffix_dedup.powers.cache_info()
    assert after.misses - before.misses <= 1 and after.hits - before.hits > 10
    seen, anchors = [], {}
    for owner, key, start, stop, place in found:
        data = texts[owner].encode()
        for at in range(start, stop):
            seen.append((owner, at))
            assert at <= place <= at + 50 - suffix_dedup.GRAM
            assert anchors.setdefault(data[at : at + 50], (key, place - at)) == (key, place - at)
    for text in texts:
        for _, key, start, stop, place in zip(*(x.tolist() for x in find([text]))):
            assert all(anchors[text.encode()[at : at + 50]] == (key, place - at) for at in range(start, stop))
    assert sorted(seen) == [(i, at) for i, x in enumerate(texts) for at in range(len(x.encode()) - 49)]


def test_leftmost_minimum_of_neighbours():
    values = np.random.default_rng(1).integers(0, 6, 300).astype(np.uint64)
    for width in (1, 2, 5, 27):
        assert suffix_dedup.smallest(values, width, 9).tolist() == [i + int(np.argmin(values[i : i + width])) for i in range(300 - width + 1)]
