"""Suffix-array deduplication: bytes covered by a string that also starts in an earlier document.

Suffixes are compared by their first words of eight bytes, and where these agree by prefix polynomial hashes: a binary
search over lengths finds the longest common extension in logarithmic time, and the byte after it decides.  Suffixes that
share ``length`` bytes have one hash of so many bytes and are one class, for which one of them is merge-sorted with that
comparison among the suffixes of its group; the smallest document id of a class decides what is removed.  Classes are
checked byte by byte; where a hash has collided, the group is sorted by its bytes.

Which suffixes can share that much is found through anchors: every window of ``length`` bytes picks the leftmost of its
smallest hashes of ``GRAM`` bytes.  Equal windows pick the same one, so only windows around recurring anchors are sorted,
anchor by anchor, on many tasks.

Null texts are empty.  Ids are whole numbers; a null id counts after all others.  Rows with the same id are one document
in the comparison (nothing of them is removed for each other's sake) and each judged by its own text.  Texts shorter
than ``length`` bytes stay whole.  Repeats within one document alone stay.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from siftwork.llm import windows as W
from siftwork.llm.common import U64, mix64

GRAM = 24
BASE = 0x9E3779B97F4A7C15
CHUNK, SPARE = 1 << 15, 4096  # texts are searched in pieces whose arrays stay in the processor's cache
TABLE = 1 << 20  # buffers of so many bytes take the powers from a table
WORDS = 8  # words compared before hashes are


@lru_cache(maxsize=1)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    power, back = np.full(n, BASE, np.uint64), np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    for x in (power, back):
        x[0] = 1
        np.multiply.accumulate(x, out=x)
    return power, back


class PrefixHashes:
    """Polynomial hashes of all substrings of a buffer, modulo 2**64; equal strings have equal hashes."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        power, self.back = powers(TABLE) if n < TABLE else powers.__wrapped__(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + U64(1)) * power[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, size) -> np.ndarray:
        return (self.sums[start + size] - self.sums[start]) * self.back[start]

    def grams(self, size: int) -> np.ndarray:
        """Of every substring of ``size``."""
        return (self.sums[size:] - self.sums[:-size]) * self.back[: len(self.sums) - size]


def smallest(values: np.ndarray, width: int, bits: int) -> np.ndarray:
    """Place of the leftmost minimum in every ``width`` neighbours, by what is left of the values after ``bits`` for the place.

    As many bits are left in every batch, so that equal neighbours agree.
    """
    bits, have = U64(bits), 1
    low = (values << bits) | np.arange(len(values), dtype=np.uint64)
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    return (low & ((U64(1) << bits) - U64(1))).astype(np.int64)


def byte_anchors(length: int) -> W.Anchors:
    width, bits = length - GRAM + 1, (CHUNK + length).bit_length()

    def find(texts: list[str]):
        parts = [x.encode("utf-8", "surrogatepass") for x in texts]
        ends = np.cumsum([len(x) for x in parts], dtype=np.int64)
        begins = ends - np.array([len(x) for x in parts], np.int64)
        data = np.frombuffer(b"".join(parts), np.uint8)
        out = []
        for c in range(0, len(data) - length + 1, CHUNK):
            piece = data[c : c + CHUNK + length - 1]
            grams = mix64(PrefixHashes(piece).grams(GRAM))
            place = smallest(grams, width, bits)[: len(piece) - length + 1]
            first, last = np.searchsorted(ends, [c, c + len(place) - 1], side="right")
            counts = np.diff(np.minimum(ends[first : last + 1], c + len(place)), prepend=c)
            owner = np.repeat(np.arange(first, last + 1), counts)
            valid = np.arange(c + length, c + length + len(place)) <= np.repeat(ends[first : last + 1], counts)
            runs, stops = W.grouped_runs(valid, owner, place)
            own = owner[runs]
            out.append((own, grams[place[runs]], runs + c - begins[own], stops + c - begins[own], place[runs] + c - begins[own]))
        if not out:
            none = np.zeros(0, np.int64)
            return none, none.view(np.uint64), none, none, none
        return tuple(np.concatenate(x) for x in zip(*out))

    return find


def byte_cutter(length: int):
    def prepare(texts: list[str]) -> Callable[[int, int, int], bytes]:
        parts = [x.encode("utf-8", "surrogatepass") for x in texts]
        return lambda o, start, stop: parts[o][start : stop - 1 + length]

    return prepare


def byte_windows(length: int) -> Callable[[bytes], list[bytes]]:
    return lambda body: [body[i : i + length] for i in range(len(body) - length + 1)]


class SuffixOrder:
    """Merge sort of suffixes within groups, comparing by hashes."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length, self.hashes = data, length, PrefixHashes(data)
        # The eight bytes from every place on, first byte highest; zeros follow the last.
        self.words = np.zeros(len(data), np.uint64)
        for i in range(min(8, len(data))):
            self.words[: len(data) - i] |= data[i:].astype(np.uint64) << U64(56 - 8 * i)

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common extension of the suffixes at ``a`` and ``b``, up to ``length``."""
        same = np.full(len(a), self.length, np.int64)
        differ = np.flatnonzero(self.hashes.of(a, self.length) != self.hashes.of(b, self.length))
        x, y, low = a[differ], b[differ], np.zeros(len(differ), np.int64)
        step = 1 << (self.length.bit_length() - 1)
        while step:
            fits = low + step < self.length
            reach = np.where(fits, step, 0)
            longer = fits & (self.hashes.of(x + low, reach) == self.hashes.of(y + low, reach))
            low = low + np.where(longer, step, 0)
            step >>= 1
        same[differ] = low
        return same

    def before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether suffix ``a`` comes before ``b`` in their first ``length`` bytes; they differ in these."""
        out, todo = np.zeros(len(a), bool), None
        for step in range(0, min(self.length, 8 * WORDS), 8):
            x, y = (self.words.take(p + step if todo is None else p[todo] + step, mode="clip") for p in (a, b))
            if todo is None:
                out, todo = x < y, np.flatnonzero(x == y)
            else:
                out[todo] = x < y
                todo = todo[x == y]
            if not len(todo):
                return out
        a, b = a[todo], b[todo]
        at = np.minimum(self.extension(a, b), self.length - 1)
        out[todo] = self.data[a + at] < self.data[b + at]
        return out

    def sort(self, order: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """``order`` holds suffixes group after group, all of a group different; per element its group's begin and size."""
        order, index, width = order.copy(), np.arange(len(order)), 1
        while True:
            at = index[size > width]
            if not len(at):
                return order
            first, inside = begin[at], at - begin[at]
            pair = inside - inside % (2 * width)
            right = inside - pair >= width
            middle = np.minimum(pair + width, size[at])
            end = np.minimum(pair + 2 * width, size[at])
            low, high = np.where(right, pair, middle), np.where(right, middle, end)
            other = low.copy()
            mine = order[at]
            todo = np.flatnonzero(low < high)
            while len(todo):
                half = (low[todo] + high[todo]) // 2
                theirs = order[first[todo] + half]
                ahead = self.before(theirs, mine[todo])
                low[todo] = np.where(ahead, half + 1, low[todo])
                high[todo] = np.where(ahead, high[todo], half)
                todo = todo[low[todo] < high[todo]]
            other = low - np.where(right, pair, middle)
            own = inside - np.where(right, middle, pair)
            order[first + pair + own + other] = mine
            width *= 2

    def classes(self, order: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted suffixes, and where a new class of equal first ``length`` bytes starts."""
        order, new = order.copy(), np.ones(len(order), bool)
        several = np.flatnonzero(size > 1)
        if not len(several):
            return order, new
        # One of equal suffixes is sorted, the others follow it.
        mine, first = order[several], several == begin[several]
        group, whole = np.cumsum(first) - 1, self.hashes.of(mine, self.length)
        by = np.lexsort((whole, group))
        head = np.ones(len(by), bool)
        head[1:] = (group[by[1:]] != group[by[:-1]]) | (whole[by[1:]] != whole[by[:-1]])
        heads = np.flatnonzero(head)
        ones, group = mine[by[heads]], group[by[heads]]
        sizes = np.bincount(group)
        begins = np.cumsum(sizes) - sizes
        places = np.argsort(ones)
        ranks = places[np.searchsorted(ones, self.sort(ones, begins[group], sizes[group]), sorter=places)]
        counts = np.diff(np.append(heads, len(by)))[ranks]
        begun = np.cumsum(counts) - counts
        order[several] = mine[by[np.repeat(heads[ranks] - begun, counts) + np.arange(len(by))]]
        new[several] = False
        new[several[begun]] = True
        equal, steps = np.flatnonzero(~new), np.arange(self.length)
        wrong = []
        for s in range(0, len(equal), 65536):
            e = equal[s : s + 65536]
            wrong.append(e[(self.data[order[e][:, None] + steps] != self.data[order[e - 1][:, None] + steps]).any(axis=1)])
        for b in np.unique(begin[np.concatenate(wrong)]) if wrong else []:
            # A collision: the group is sorted by its bytes.
            group = slice(b, b + size[b])
            text = [self.data[p : p + self.length].tobytes() for p in order[group]]
            by = sorted(range(len(text)), key=text.__getitem__)
            order[group] = order[group][by]
            new[b + 1 : b + size[b]] = [text[i] != text[j] for i, j in zip(by, by[1:])]
        return order, new


def judge_bytes(length: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def judge(frame: pd.DataFrame) -> pd.DataFrame:
        bodies = frame["body"].tolist()
        sizes = np.array([len(x) for x in bodies], np.int64)
        counts = sizes - length + 1
        begins = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(bodies)), counts)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = begins[owner] + inside
        # Equal windows have their anchor at the same place.
        key, place = frame["key"].to_numpy()[owner], frame["lead"].to_numpy(np.int64)[owner] - inside
        by = np.lexsort((start, place, key))
        key, place = key[by], place[by]
        new = np.ones(len(by), bool)
        new[1:] = (key[1:] != key[:-1]) | (place[1:] != place[:-1])
        at = np.flatnonzero(new)
        size = np.diff(np.append(at, len(by)))
        suffixes = SuffixOrder(np.frombuffer(b"".join(bodies), np.uint8), length)
        order, fresh = suffixes.classes(start[by], np.repeat(at, size), np.repeat(size, size))
        where = np.empty(sum(sizes), np.int64)
        where[start] = np.arange(len(start))
        where = where[order]
        low = frame["low"].to_numpy(np.int64)
        heads = np.flatnonzero(fresh)
        least = np.empty(len(order), np.int64)
        least[where] = np.repeat(np.minimum.reduceat(low[owner[where]], heads), np.diff(np.append(heads, len(order))))
        flags = (least < low[owner]) | (frame["times"].to_numpy()[owner] > 1)
        return answers(frame, flags, owner, inside, least)

    return judge


def answers(frame: pd.DataFrame, flags: np.ndarray, owner: np.ndarray, inside: np.ndarray, low: np.ndarray) -> pd.DataFrame:
    """Runs of flagged windows with one smallest id, listed per context."""
    starts, stops = W.grouped_runs(flags, owner, low)
    own = owner[starts]
    first = np.flatnonzero(np.diff(own, prepend=-1))
    some, edges = own[first], [*first.tolist(), len(own)]

    def lists(x: np.ndarray) -> pd.Series:
        return pd.Series([x[a:b] for a, b in zip(edges[:-1], edges[1:])], dtype=object)

    return pd.DataFrame(
        {
            "key": frame["key"].to_numpy()[some],
            "mark": frame["mark"].to_numpy()[some],
            "froms": lists(inside[starts].astype(np.int32)),
            "tos": lists((inside[starts] + stops - starts).astype(np.int32)),
            "lows": lists(low[starts]),
        }
    )


def repeated_bytes(df: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = 50) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents, their classes, and per class the ranges of window starts that an earlier document has too."""
    if length < GRAM:
        raise ValueError(f"strings must have at least {GRAM} bytes")
    docs = W.documents(df, key, text)
    parts = W.partitions_of(docs)
    anchors = byte_anchors(length)
    classes = W.text_classes(docs)
    found = W.contexts(docs, classes, W.recurring(docs, anchors, False, parts), anchors, byte_cutter(length))
    return docs, classes, W.spans(found, W.judged(found, judge_bytes(length), byte_windows(length), parts), F.col("low") < F.col("id"))


def remove_repeats(df: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = 50, with_bytes: bool = True) -> DataFrame:
    """Per row: key, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and (``with_bytes``) ``kept`` and the ``removed`` ranges."""
    docs, classes, found = repeated_bytes(df, key=key, text=text, length=length)

    def finish(body: str, ranges: list[tuple[int, int]], whole: bool) -> tuple:
        data = body.encode("utf-8", "surrogatepass")
        ranges = [(0, len(data))] if whole and len(data) >= length else ranges
        edges = [0, *[x for r in ranges for x in r], len(data)]
        kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
        out = (len(data), len(data) - len(kept), len(ranges), hashlib.sha256(kept).hexdigest())
        return (*out, kept, [list(r) for r in ranges]) if with_bytes else out

    schema, names = "n_bytes long, n_removed long, n_spans long, kept_sha256 string", ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    if with_bytes:
        schema, names = schema + ", kept binary, removed array<array<long>>", [*names, "kept", "removed"]
    out = W.applied(docs, classes, found, F.col("id") > F.col("low"), finish, length, schema, names)
    return out.withColumn("id", F.when(F.col("id") < (1 << 63) - 1, F.col("id"))).withColumnRenamed("id", key)
