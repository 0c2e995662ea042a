"""Helpers shared by the corpus operators: word lists, 64-bit hashes over NumPy arrays, text digests."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Words are runs of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = re.compile("[^\x20\x09-\x0d]+")
U64 = np.uint64


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hands the package to all workers once per application, for sessions that were started without it."""
    if spark.sparkContext.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="run-package-"), "siftwork.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(spark.sparkContext.applicationId)


def find_words(text: str | None) -> list[str]:
    """The words of a text; null has none.

    ``str.split`` also cuts at a few rarer spaces, so it serves only texts without them.
    """
    if not text:
        return []
    return WORD.findall(text) if _RARE.search(text) else text.split()


_RARE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def mix64(h: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values (a bijection), so that every bit depends on all bits."""
    h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return h ^ (h >> U64(32))


def word_ids(lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """All words of a batch as numbers: (ids, offsets of each list, distinct words)."""
    names: dict[str, int] = {}
    give = names.setdefault
    offsets = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    ids = np.fromiter((give(w, len(names)) for words in lists for w in words), np.int64, count=int(offsets[-1]))
    return ids, offsets, list(names)


def word_hashes(words: list[str]) -> np.ndarray:
    """A 64-bit hash per word, the same in every process."""
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, count=len(words))


def signed(h: np.ndarray) -> np.ndarray:
    """Unsigned hashes as the signed longs that Spark holds."""
    return h.astype(np.uint64).view(np.int64)


def text_of(column: str) -> Column:
    """The whole text, null as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def slices(frames: Iterator[pd.DataFrame], column: str, characters: int = 4_000_000) -> Iterator[pd.DataFrame]:
    """Arrow batches cut so that each piece holds about ``characters`` of text, or a single row."""
    for frame in frames:
        if frame.empty:
            continue
        size = frame[column].str.len().fillna(0).to_numpy(np.int64)
        piece = np.cumsum(size) // characters
        for start, stop in _edges(piece):
            yield frame.iloc[start:stop]


def small(frames: Iterator[pd.DataFrame], rows: int = 1000) -> Iterator[pd.DataFrame]:
    """Arrow batches cut to at most ``rows`` rows."""
    for frame in frames:
        for start in range(0, len(frame), rows):
            yield frame.iloc[start : start + rows]


def _edges(values: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = np.flatnonzero(np.diff(values)) + 1
    return zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)])


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that ``df`` doesn't have, close to the wanted ones."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
