"""Substring deduplication of word windows by recompression.

A text of words is compressed in rounds.  A round first joins runs of one symbol, then pairs: every symbol falls on one
of two sides by a bit of its name, and a symbol of the first side joins the one of the second side that follows it.  The
name of a joined symbol is a hash of what it is made of, so all tasks give the same names without asking each other, and
equal stretches of text get equal symbols in their interiors.  How far an interior reaches is known exactly: each symbol
carries the range of words that decided its making, and inside a window that holds this range the symbol is certain.

Every window of ``length`` words is represented by one of its certain symbols: the one with the smallest hash of name and
content among those decided by a third to a half of the window, or else among those of its highest level.  Symbols shared by two places reveal possible repeats; the words of the windows around them
are then compared, and a window counts as repeated if its words occur in two places or more, in one text or in several.

Null texts have no words; texts below ``length`` words stay whole.  Rows with equal ids are judged each by its own text,
and count as two places.  Null ids keep their own results.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from siftwork.llm import windows as W
from siftwork.llm.common import U64, find_words, mix64, word_hashes, word_ids
from siftwork.llm.suffix_dedup import PrefixHashes, answers

ROUNDS = 8
FAR = 1 << 40
CHUNK = 200_000
ODD = U64(0x100000001B3)


def rounds(names: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per level: symbol names, and the first and last + 1 word that decided them (far out where the text's edge did)."""
    low, high = np.arange(len(names)), np.arange(1, len(names) + 1)
    yield names, low, high
    for level in range(1, ROUNDS + 1):
        if not len(names):
            return
        # Runs of one symbol.
        new = np.ones(len(names), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (names[1:] != names[:-1])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(names)))
        last = first + size - 1
        low_in, high_in = np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)
        (low_b, high_b), (low_a, high_a) = _neighbours(low, high, owner)
        low = np.minimum(low_in, np.minimum(low_b[first], low_a[last]))
        high = np.maximum(high_in, np.maximum(high_b[first], high_a[last]))
        long = size > 1
        names = names[first].copy()
        names[long] = mix64(names[long] * ODD + size[long].astype(np.uint64))
        owner = owner[first]
        # Pairs across the two sides.
        side = (mix64(names ^ U64(0x5851F42D4C957F2D + level)) & U64(1)).astype(bool)
        joins = np.zeros(len(names), bool)
        joins[:-1] = ~side[:-1] & side[1:] & (owner[:-1] == owner[1:])
        joined = np.zeros(len(names), bool)
        joined[1:] = joins[:-1]
        at = np.flatnonzero(~joined)
        pair = joins[at]
        mate = np.minimum(at + 1, len(names) - 1)
        # A symbol left alone has seen the neighbour it might have joined, with all that decided that neighbour.
        (low_b, high_b), (low_a, high_a) = _neighbours(low, high, owner)
        seen_low = np.where(pair, low[mate], np.where(side[at], low_b[at], low_a[at]))
        seen_high = np.where(pair, high[mate], np.where(side[at], high_b[at], high_a[at]))
        new_low, new_high = np.minimum(low[at], seen_low), np.maximum(high[at], seen_high)
        names = np.where(pair, mix64(mix64(names[at]) * ODD + names[mate]), names[at])
        low, high, owner = new_low, new_high, owner[at]
        yield names, low, high


def _neighbours(low: np.ndarray, high: np.ndarray, owner: np.ndarray) -> tuple:
    """(low, high) of the words that decided the symbol before, and the symbol after; far out at the edges of a text."""
    same = owner[1:] == owner[:-1]
    out = [np.full(len(low), -FAR), np.full(len(low), FAR), np.full(len(low), -FAR), np.full(len(low), FAR)]
    for i, values in enumerate((low, high)):
        out[i][1:][same] = values[:-1][same]
        out[i + 2][:-1][same] = values[1:][same]
    return (out[0], out[1]), (out[2], out[3])


def representatives(hashes: np.ndarray, owner: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Per window start: key of its representative, and the first word that decided it (-1 where no window starts)."""
    n = len(hashes)
    place, keys = np.full(n, -1), np.zeros(n, np.uint64)
    count = n - length + 1
    if count <= 0:
        return place, keys
    open_ = np.zeros(n, bool)
    open_[:count] = owner[:count] == owner[length - 1 :]
    content = PrefixHashes(hashes)
    levels = [(names + U64(i + 1), low, high) for i, (names, low, high) in enumerate(rounds(hashes, owner))]
    levels = [tuple(x[(low >= 0) & (high <= n) & (high - low <= length)] for x in (names, low, high)) for names, low, high in levels]
    # First choice: symbols decided by a third to a half of a window, which stay certain while the window moves on.
    middle = [tuple(x[(high - low > length // 3) & (high - low <= length // 2)] for x in (names, low, high)) for names, low, high in levels]
    for names, low, high in [tuple(np.concatenate(x) for x in zip(*middle)), *levels[::-1]]:
        begin = np.maximum(high - length, 0)
        waiting = np.append(0, np.cumsum(open_))
        useful = waiting[low + 1] > waiting[begin]
        names, low, high, begin = names[useful], low[useful], high[useful], begin[useful]
        if not len(low):
            continue
        key = mix64(content.of(low, high - low) ^ mix64(names))
        times = low + 1 - begin
        symbol = np.repeat(np.arange(len(low)), times)
        window = np.arange(len(symbol)) - np.repeat(np.cumsum(times) - times, times) + begin[symbol]
        mine = open_[window]
        symbol, window = symbol[mine], window[mine]
        best = np.full(n, ~U64(0))
        np.minimum.at(best, window, key[symbol])
        win = np.flatnonzero(key[symbol] == best[window])
        win = win[np.argsort(-low[symbol[win]], kind="stable")]  # the leftmost of equals is written last
        keys[window[win]], place[window[win]] = key[symbol[win]], low[symbol[win]]
        open_[window] = False
    return place, keys


def word_anchors(length: int) -> W.Anchors:
    def find(texts: list[str]):
        # Long texts are cut into overlapping parts: what represents a window depends on its words alone.
        lists, text, base = [], [], []
        for i, words in enumerate(map(find_words, texts)):
            for s in range(0, max(1, len(words) - length + 1), CHUNK):
                lists.append(words[s : s + CHUNK + length - 1])
                text.append(i)
                base.append(s)
        ids, offsets, names = word_ids(lists)
        hashes = mix64(word_hashes(names))[ids]
        owner = np.repeat(np.arange(len(lists)), np.diff(offsets))
        place, keys = representatives(hashes, owner, length)
        starts, stops = W.grouped_runs(place >= 0, owner, mix64(keys + place.astype(np.uint64)))
        own = owner[starts]
        shift = np.array(base, np.int64)[own] - offsets[own]
        return np.array(text, np.int64)[own], keys[starts], starts + shift, stops + shift, place[starts] + shift

    return find


def word_cutter(length: int):
    def prepare(texts: list[str]) -> Callable[[int, int, int], bytes]:
        lists = [find_words(x) for x in texts]
        return lambda o, start, stop: " ".join(lists[o][start : stop - 1 + length]).encode("utf-8", "surrogatepass")

    return prepare


def word_windows(length: int) -> Callable[[bytes], list[bytes]]:
    def cut(body: bytes) -> list[bytes]:
        words = body.split(b" ")
        return [b" ".join(words[i : i + length]) for i in range(len(words) - length + 1)]

    return cut


def judge_words(length: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def judge(frame: pd.DataFrame) -> pd.DataFrame:
        lists = [x.decode("utf-8", "surrogatepass").split(" ") for x in frame["body"]]
        ids, offsets, names = word_ids(lists)
        content = PrefixHashes(mix64(word_hashes(names))[ids])
        counts = np.diff(offsets) - length + 1
        owner = np.repeat(np.arange(len(lists)), counts)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = offsets[owner] + inside
        key, place = frame["key"].to_numpy()[owner], frame["lead"].to_numpy(np.int64)[owner] - inside
        window = content.of(start, length)
        by = np.lexsort((window, place, key))
        same = np.zeros(len(by), bool)
        same[1:] = (key[by][1:] == key[by][:-1]) & (place[by][1:] == place[by][:-1]) & (window[by][1:] == window[by][:-1])
        name = np.cumsum(~same)
        # Words, not hashes, decide.  Where hashes have collided, the windows are named by their words.
        equal, steps = np.flatnonzero(same), np.arange(length)
        for s in range(0, len(equal), 65536):
            e = equal[s : s + 65536]
            wrong = e[(ids[start[by[e]][:, None] + steps] != ids[start[by[e - 1]][:, None] + steps]).any(axis=1)]
            for c in np.unique(name[wrong]):
                at = np.flatnonzero(name == c)
                words = [ids[p : p + length].tobytes() for p in start[by[at]]]
                seen = {w: name.max() + 1 + i for i, w in enumerate(dict.fromkeys(words))}
                name[at] = [seen[w] for w in words]
        times = np.bincount(name, weights=frame["times"].to_numpy()[owner[by]])
        flags = np.zeros(len(by), bool)
        flags[by] = times[name] > 1
        return answers(frame, flags, owner, inside, np.zeros(len(by), np.int64))

    return judge


def remove_repeats(df: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = 35, with_words: bool = True) -> DataFrame:
    """Per row: key, ``n_words``, ``n_removed``, ``kept_sha256`` and (``with_words``) ``kept`` and the ``removed`` ranges of words."""
    docs = W.documents(df, key, text)
    parts = W.partitions_of(docs)
    anchors = word_anchors(length)
    classes = W.text_classes(docs)
    found = W.contexts(docs, classes, W.recurring(docs, anchors, True, parts), anchors, word_cutter(length))
    spans = W.spans(found, W.judged(found, judge_words(length), word_windows(length), parts), F.lit(True))

    def finish(body: str, ranges: list[tuple[int, int]], whole: bool) -> tuple:
        words = find_words(body)
        ranges = [(0, len(words))] if whole and len(words) >= length else ranges
        edges = [0, *[x for r in ranges for x in r], len(words)]
        kept = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]
        joined = " ".join(kept)
        out = (len(words), len(words) - len(kept), hashlib.sha256(joined.encode("utf-8", "surrogatepass")).hexdigest())
        return (*out, joined, [list(r) for r in ranges]) if with_words else out

    schema, names = "n_words long, n_removed long, kept_sha256 string", ["n_words", "n_removed", "kept_sha256"]
    if with_words:
        schema, names = schema + ", kept string, removed array<array<long>>", [*names, "kept", "removed"]
    out = W.applied(docs, classes, spans, F.col("copies") > 1, finish, length, schema, names)
    return out.withColumn("id", F.when(F.col("id") < (1 << 63) - 1, F.col("id"))).withColumnRenamed("id", key)
