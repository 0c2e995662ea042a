"""Phrase collocations by SETM: set-oriented mining with sorted occurrence relations.

Level 1 is the relation of all word occurrences, sorted by piece and position.  A level's groups are counted by one Spark
aggregate, and the frequent ones get an id.  Occurrences are semi-joined with these, and the relation that is left is
merge-joined with itself: an occurrence of k words and the one at the next position of the same piece are an occurrence
of k + 1 words, whose group is the pair of both ids.  So every phrase is named exactly, without hashing, and no level
looks at the text again.

Relations are persisted in blocks of a few million positions of one language: a block holds its sorted positions and a
local number for the group at each, and one row per distinct group with its count.  Only distinct groups of a block move
through shuffles, so a word or phrase on a third of all rows is a row per block.  Positions run on through a block with
a gap at the end of each piece; adjacent positions are always of one piece.

``lang`` null counts as ``und``.  Null and empty texts hold no words; a text without separators is one piece, however
long.  Repeated rows count as often as they occur.  Ties in the ranking go by phrase, in the order of UTF-8 bytes.  An
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from siftwork.llm.common import slices, text_of
from siftwork.llm.windows import give_up_shuffles
from siftwork.sources.shared import stage

BLOCK = 3_000_000  # positions
CHUNK = 100_000  # rows of groups that travel at once
# Everything that ends a piece becomes a line feed, a tab a blank.
EVEN = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")
GAP, NOTHING = 0, 1
NONE = np.empty(0, np.int64)
# One row per group (at is null), and one with the occurrences (place is null).
LEVEL_1 = "block long, lang string, place long, word string, times long, at binary, codes binary"
LEVEL_N = "block long, place long, a long, b long, times long, at binary, codes binary"
# A group of a block is named by both numbers in one; blocks by partition and order.
CODES, BLOCKS = 29, 14


def pressed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values, "<i4").tobytes())


def unpressed(blob: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), "<i4")


class Names(dict):
    """Numbers words in the order in which they come up."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Block:
    """Occurrences of one language, as they are read."""

    def __init__(self):
        self.names = Names({b"\n": GAP, b"": NOTHING})
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, texts: list[str]) -> None:
        data = "\n".join(texts).encode("utf-8", "surrogatepass").lower().translate(EVEN)
        tokens = data.replace(b"\n", b" \n ").split(b" ")
        codes = np.fromiter(map(self.names.__getitem__, tokens), np.int32, count=len(tokens))
        self.parts += [codes[codes != NOTHING], np.array([GAP], np.int32)]
        self.size += len(codes)

    def rows(self, block: int, lang: str) -> Iterator[pd.DataFrame]:
        codes = np.concatenate(self.parts)
        at = np.flatnonzero(codes != GAP)
        codes = codes[at]
        times = np.bincount(codes, minlength=len(self.names))
        words = list(self.names)
        for start in range(NOTHING + 1, len(words), CHUNK):
            some = range(start, min(start + CHUNK, len(words)))
            yield pd.DataFrame(
                {
                    "block": block,
                    "lang": lang,
                    "place": pd.array([(block << CODES) + i for i in some], "Int64"),
                    "word": [words[i].decode("utf-8", "replace") for i in some],
                    "times": pd.array(times[some.start : some.stop], "Int64"),
                    "at": None,
                    "codes": None,
                }
            )
        yield pd.DataFrame(
            {"block": [block], "lang": lang, "place": pd.array([None], "Int64"), "word": None, "times": pd.array([None], "Int64"), "at": [pressed(np.diff(at, prepend=0))], "codes": [pressed(codes)]}
        )


def words_of(df: DataFrame, text: str, lang: str) -> DataFrame:
    """Level 1: the occurrences of all words, and per block its distinct words."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base, made = TaskContext.get().partitionId() << BLOCKS, 0
        open_blocks: dict[str, Block] = {}
        for frame in slices(frames, "body", 1_000_000):
            for name, bodies in frame.groupby("lang")["body"]:
                block = open_blocks.setdefault(name, Block())
                block.add(bodies.tolist())
                if block.size >= BLOCK:
                    yield from open_blocks.pop(name).rows(base + made, name)
                    made += 1
        for name in list(open_blocks):
            yield from open_blocks.pop(name).rows(base + made, name)
            made += 1

    language = F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und"))
    return df.select(language.alias("lang"), text_of(text).alias("body")).mapInPandas(read, LEVEL_1)


def frequent(level: DataFrame, names: list[str], least: int, name: str) -> DataFrame:
    """The frequent groups of every block: place and id; the group's names and number stand where both are the same.

    A group's id is the smallest of its places.  Its rows meet once, one per block, to be summed and to be judged.
    """
    groups = Window.partitionBy(*names)
    counted = level.where("place IS NOT NULL").select("place", *names, "times")
    counted = counted.withColumn("f", F.sum("times").over(groups)).withColumn("id", F.min("place").over(groups)).where(F.col("f") >= least)
    once = [F.when(F.col("place") == F.col("id"), F.col(n)).alias(n) for n in [*names, "f"]]
    out = stage(counted.select("place", "id", *once), name)
    give_up_shuffles(out.sparkSession)
    return out


def groups_table(block: pa.Scalar, a: np.ndarray, b: np.ndarray, times: np.ndarray) -> pa.Table:
    """One row per distinct group of a block, in chunks, which reach Spark one by one."""
    n = len(times)
    wide, number, chunks = pa.int64(), block.as_py(), []
    for start in range(0, max(n, 1), CHUNK):
        some = slice(start, min(start + CHUNK, n))
        size = some.stop - some.start
        blob = pa.nulls(size, pa.binary())
        columns = [pa.array(x, wide) for x in (np.full(size, number), (number << CODES) + np.arange(some.start, some.stop), a[some], b[some], times[some])]
        chunks.append(pa.table([*columns, blob, blob], names=[x.split()[0] for x in LEVEL_N.split(", ")]))
    return pa.concat_tables(chunks)


def numbered(first: np.ndarray, second: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of numbers below ``size``, sorted and as one number each; the place of every pair among them; their counts.

    A pair and its place are sorted as one number where 63 bits hold both, which takes a third of the memory.
    """
    bits = max(1, len(first) - 1).bit_length()
    packed = first.astype(np.int64)
    packed *= size
    packed += second
    if (size * size - 1).bit_length() + bits > 63:
        pairs, number, times = np.unique(packed, return_inverse=True, return_counts=True)
        return pairs, number.astype(np.int32), times
    packed <<= bits
    packed += np.arange(len(first), dtype=np.int32)
    packed.sort()
    place = (packed & ((1 << bits) - 1)).astype(np.int32)
    packed >>= bits
    new = np.ones(len(packed), bool)
    np.not_equal(packed[1:], packed[:-1], out=new[1:])
    number = np.empty(len(packed), np.int32)
    order = np.cumsum(new, dtype=np.int32)
    order -= 1
    number[place] = order
    del place, order
    start = np.flatnonzero(new)
    return packed[start], number, np.diff(start, append=len(packed))


def extended(level: DataFrame, found: DataFrame, last: bool) -> DataFrame:
    """The next level: occurrences of frequent groups, merge-joined with those at the next position."""

    def merge(key: tuple, occurrences: pa.Table, kept: pa.Table) -> pa.Table:
        if not len(occurrences) or not len(kept):
            return groups_table(key[0], NONE, NONE, NONE)
        # The frequent groups by the order of their ids; positions and numbers of a block are below 2**31.
        known, rank = np.unique(kept["id"].to_numpy(), return_inverse=True)
        codes, frequent_codes = unpressed(occurrences["codes"][0].as_py()), kept["code"].to_numpy()
        ranks = np.full(max(int(codes.max(initial=0)), int(frequent_codes.max())) + 1, -1, np.int32)
        ranks[frequent_codes] = rank
        flat = ranks[codes]
        del codes
        at = np.cumsum(unpressed(occurrences["at"][0].as_py()), dtype=np.int32)
        at = at[flat >= 0]
        flat = flat[flat >= 0]
        # Both sides are sorted by position, and a position holds one group: the partner is the next row or missing.
        join = np.flatnonzero(np.diff(at) == 1).astype(np.int32)
        at = at[join]
        pair, number, times = numbered(flat[join], flat[join + 1], len(known))
        del flat, join
        groups = groups_table(key[0], known[pair // len(known)], known[pair % len(known)], times)
        if last or not len(at):
            return groups
        where = {"block": [key[0]], "place": [None], "a": [None], "b": [None], "times": [None], "at": [pressed(np.diff(at, prepend=0))], "codes": [pressed(number)]}
        return pa.concat_tables([groups, pa.table(where, schema=groups.schema)])

    code = F.col("place").bitwiseAND((1 << CODES) - 1).cast("int").alias("code")
    kept = found.select(F.shiftright("place", CODES).alias("owner"), code, "id")
    places = level.where("place IS NULL").select("block", "at", "codes")
    return places.groupBy("block").cogroup(kept.groupBy("owner")).applyInArrow(merge, LEVEL_N)


def mined(df: DataFrame, text: str, lang: str, least: int, most_words: int) -> tuple[DataFrame, list[DataFrame]]:
    """Word totals per language, and per length the frequent phrases with the counts of all their beginnings and ends."""
    level = stage(words_of(df, text, lang), "occurrences-1")
    totals = level.where("place IS NOT NULL").groupBy("lang").agg(F.sum("times").alias("n"))
    found = frequent(level, ["lang", "word"], least, "groups-1")
    none = F.array().cast("array<long>")
    first = found.where("place = id").select("id", "lang", F.col("word").alias("phrase"), "f", none.alias("heads"), none.alias("tails"))
    phrases = [first]
    for k in range(2, most_words + 1):
        level = stage(extended(level, found, k == most_words), f"occurrences-{k}")
        found = frequent(level, ["a", "b"], least, f"groups-{k}")
        x, y = phrases[-1].alias("x"), phrases[-1].alias("y")
        joined = found.where("place = id").alias("g").join(x, F.col("g.a") == F.col("x.id")).join(y, F.col("g.b") == F.col("y.id"))
        phrase = F.concat("x.phrase", F.lit(" "), F.substring_index("y.phrase", " ", -1))
        heads, tails = F.array_append("x.heads", F.col("x.f")), F.array_append("y.tails", F.col("y.f"))
        named = joined.select("g.id", "g.a", "g.b", "x.lang", phrase.alias("phrase"), "g.f", heads.alias("heads"), tails.alias("tails"))
        phrases.append(stage(named, f"phrases-{k}"))
    return totals, phrases


def weakest_cut(k: int) -> Column:
    """The cut with the lowest score, the first of equal ones."""

    def scored(i: Column) -> Column:
        left, right = F.element_at("heads", i.cast("int")), F.element_at("tails", (F.lit(k) - i).cast("int"))
        return F.struct(floor_score(F.col("f"), left + right).alias("score"), i.alias("cut"), left.alias("l"), right.alias("r"))

    return F.array_min(F.transform(F.sequence(F.lit(1), F.lit(k - 1)), scored))


def floor_score(a: Column, both: Column) -> Column:
    """Two million times ``a`` by ``both``, floored; decimals, as the product passes 64 bits."""
    return F.call_function("div", F.lit(2_000_000).cast("decimal(7,0)") * a.cast("decimal(20,0)"), both.cast("decimal(20,0)"))


def phrases(
    df: DataFrame, *, text: str = "text", lang: str = "lang", min_count: int = 30, max_words: int = 4, inside_share: int = 80, top: int | None = 2000
) -> DataFrame:
    """Per language the ``top`` phrases (None: all): lang, rank, phrase, a, l, r, n, score.

    A candidate goes if a longer one around it is found at least ``inside_share`` percent as often.  Only phrases that are
    longer by one word need a look: one longer still has a part of that length around the candidate, at least as often.
    """
    totals, found = mined(df, text, lang, min_count, max_words)
    out = []
    for k in range(2, max_words + 1):
        mine = found[k - 1]
        if k < max_words:
            longer = found[k]
            around = longer.select(F.col("a").alias("id"), "f").unionByName(longer.select(F.col("b").alias("id"), "f"))
            mine = mine.join(around.groupBy("id").agg(F.max("f").alias("longest")), "id", "left")
            covered = F.lit(100).cast("decimal(3,0)") * F.col("longest").cast("decimal(20,0)") >= F.lit(inside_share).cast("decimal(3,0)") * F.col("f").cast("decimal(20,0)")
            mine = mine.where(~F.coalesce(covered, F.lit(False)))
        cut = mine.withColumn("cut", weakest_cut(k))
        out.append(cut.select("lang", "phrase", F.col("f").alias("a"), F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score")))
    best = out[0]
    for more in out[1:]:
        best = best.unionByName(more)
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    best = best.withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:
        best = best.where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


# The same in SQL, on the table ``documents``.
ORACLE = r"""
WITH pieces AS (SELECT COALESCE(lang, 'und') AS lang, UNNEST(regexp_split_to_array(translate(COALESCE(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[ \t]+') IF x <> ''] AS w FROM pieces),
grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM
         (SELECT lang, w, k, UNNEST(range(1, len(w) - k + 2)) AS i FROM words, (SELECT UNNEST([1, 2, 3, 4]) AS k) WHERE len(w) >= k)),
freq AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, COUNT(*) AS f FROM grams GROUP BY lang, k, phrase HAVING COUNT(*) >= 30),
totals AS (SELECT lang, COUNT(*) AS n FROM grams WHERE k = 1 GROUP BY lang),
cuts AS (SELECT c.lang, c.k, c.phrase, c.f AS a, x.f AS l, y.f AS r, CAST(2000000::HUGEINT * c.f // (x.f + y.f) AS BIGINT) AS score, x.k AS cut
         FROM freq c JOIN freq x ON x.lang = c.lang AND x.k < c.k AND x.phrase = array_to_string(c.w[1:x.k], ' ')
         JOIN freq y ON y.lang = c.lang AND y.k = c.k - x.k AND y.phrase = array_to_string(c.w[x.k + 1:c.k], ' ')),
weakest AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS p FROM cuts) WHERE p = 1),
inner_parts AS (SELECT lang, f, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM
         (SELECT lang, f, w, m, UNNEST(range(1, k - m + 2)) AS i FROM freq, (SELECT UNNEST([2, 3]) AS m) WHERE m < k)),
covered AS (SELECT lang, phrase, MAX(f) AS f FROM inner_parts GROUP BY lang, phrase),
kept AS (SELECT weakest.* FROM weakest LEFT JOIN covered USING (lang, phrase) WHERE covered.f IS NULL OR 100 * covered.f < 80 * a),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
