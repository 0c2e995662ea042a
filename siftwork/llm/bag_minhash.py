"""Near-duplicate documents by BagMinHash signatures, bands and exact multiset overlap.

A document is the multiset of its five-word shingles.  Weights are discretised by powers of two: every shingle has one
Poisson process per level, whose rate is the level's width, and each point falls on one unit of weight and one component
of the signature.  A document sees the points on units below its own count, and a component holds the earliest.  Two
documents agree in a component with exactly their weighted Jaccard similarity as probability.  Processes are followed
only up to the time at which all components of the document are likely to be set (and further where they aren't), so
most shingles cost one random number.

Documents with the same words are one class.  Classes that agree in a band of the signature meet in a bucket.  First all
members of a bucket are compared with its leader, the one that meets most others.  When the links found have joined the
bucket into components, only pairs across components remain.  Members of such buckets are put into blocks of bounded
size: those of a large component together, others by the main component of their largest bucket, all by size class (linked texts are in the same class or in neighbouring ones), and pairs
of blocks that meet in a bucket are compared within a task, all texts of one with all of the other by one product of
matrices; a pair of blocks gives a spanning forest of its links, never the pairs.  Pairs of blocks are left out if exact
bounds say that they hold no link (sizes, and distances to the bucket's leader, which differ by no more than the pair
may) or if all their members in the bucket are in one component.  Links are decided by the exact overlap of the word
shingles.  With 32 bands of 4, a pair at the threshold of 0.8 is missed with a probability of 5e-8.

Texts of one to four words have a single shingle, all their words.  Texts without words (and null ones) form one class
of their own.  Rows with equal ids are judged each by its own text; a null id counts after all others, and a group without
any id has a null one.  ``one_of_each`` keeps exactly one row of a group, whatever its rows share.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from siftwork.llm.common import U64, find_words, fresh, mix64, signed, slices, text_of, word_hashes, word_ids
from siftwork.llm.components import connected
from siftwork.sources.shared import stage

SHINGLE = 5
BANDS, ROWS = 32, 4
COMPONENTS = BANDS * ROWS
STEP = U64(0x9E3779B97F4A7C15)
BLOCK, BLOCK_CHARS = 512, 4_000_000  # texts and characters that a block holds, about
LARGE = 64  # members from which a component has blocks of its own
COLUMNS = 4096


def shingles(lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of a batch of word lists: (text, shingle hash, count), ordered by both."""
    ids, offsets, names = word_ids(lists)
    words = mix64(word_hashes(names))[ids]
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(len(lists)), sizes)
    whole = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    n = max(0, len(words) - SHINGLE + 1)
    value = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        value = mix64(value * U64(0x100000001B3) + words[k : k + n] + U64(k + 1))
    inside = owner[:n] == owner[SHINGLE - 1 :] if n else np.zeros(0, bool)
    short = []
    for i in whole:
        h = np.array([sizes[i]], np.uint64)
        for w in words[offsets[i] : offsets[i + 1]]:
            h = mix64(h * U64(0x100000001B3) + w)
        short.append(h[0])
    text = np.concatenate([owner[:n][inside], whole])
    value = np.concatenate([value[inside], np.array(short, np.uint64)])
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    first = np.ones(len(text), bool)
    first[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(first)
    return text[at], value[at], np.diff(np.append(at, len(text)))


def signatures(text: np.ndarray, value: np.ndarray, count: np.ndarray, texts: int) -> np.ndarray:
    """Earliest times per text and component; infinite for texts without shingles."""
    out = np.full((texts, COMPONENTS), np.inf)
    weight = np.bincount(text, weights=count, minlength=texts)
    horizon = np.divide(COMPONENTS * (math.log(COMPONENTS) + 4.0), weight, out=np.zeros(texts), where=weight > 0)
    open_texts = weight > 0
    while open_texts.any():
        mine = open_texts[text]
        _points(text[mine], value[mine], count[mine], horizon, out)
        open_texts = open_texts & np.isinf(out).any(axis=1)
        out[open_texts] = np.inf
        horizon[open_texts] *= 2.0
    return out


def _points(text: np.ndarray, value: np.ndarray, count: np.ndarray, horizon: np.ndarray, out: np.ndarray) -> None:
    """Runs the processes of all shingles and levels up to the texts' horizons."""
    flat, limit = out.reshape(-1), None
    levels = int(count.max()).bit_length() if len(count) else 0
    for level in range(levels + 1):
        # Level 0 holds the first unit of weight, level l the units from 2**(l-1) up to 2**l.
        low, width = (0, 1) if level == 0 else (1 << (level - 1), 1 << (level - 1))
        held = np.flatnonzero(count > low)
        owner, units = text[held], count[held]
        limit = horizon[owner]
        state = mix64(value[held] + np.array([level + 1], np.uint64) * STEP)
        time = np.zeros(len(held))
        while len(owner):
            state = mix64(state + STEP)
            time = time - np.log(((state >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53) / width
            alive = time <= limit
            owner, units, limit, state, time = owner[alive], units[alive], limit[alive], state[alive], time[alive]
            spot = mix64(state ^ STEP)
            seen = (low + ((spot >> U64(32)) & U64(width - 1)).astype(np.int64)) < units
            place = owner * COMPONENTS + (spot & U64(0xFFFFFFFF)).astype(np.int64) % COMPONENTS
            np.minimum.at(flat, place[seen], time[seen])


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per text and band; equal where the band's components are."""
    bits = signature.reshape(len(signature), BANDS, ROWS).view(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * STEP, bits.shape[:2]).copy()
    for r in range(ROWS):
        key = mix64(key * U64(0x100000001B3) + bits[:, :, r])
    return key


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets (sorted values, counts)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / max(1, int(a[1].sum()) + int(b[1].sum()) - both)


def same_words(text: Column) -> Column:
    """Digest of the words of a text, whatever stands between them."""
    return F.unhex(F.md5(F.btrim(F.regexp_replace(text, r"[ \t\n\x0B\f\r]+", " "), F.lit(" ")).cast("binary")))


def sketched(df: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: id, class digest, band keys (null without words)."""

    def sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, "body", 2_000_000):
            owner, value, count = shingles([find_words(x) for x in frame["body"]])
            keys = signed(band_keys(signatures(owner, value, count, len(frame))))
            filled = np.bincount(owner, minlength=len(frame)) > 0
            yield pd.DataFrame({"id": frame["id"], "node": frame["node"], "bands": [k if f else None for k, f in zip(keys, filled)]})

    rows = df.select(F.col(f"`{key}`").alias("id"), same_words(text_of(text)).alias("node"), text_of(text).alias("body"))
    return rows.mapInPandas(sketch, f"id {df.schema[key].dataType.simpleString()}, node binary, bands array<long>")


def overlaps(x: list[tuple[np.ndarray, np.ndarray]], y: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Sizes of the multiset intersections of all of ``x`` with all of ``y``."""

    def items(bags: list) -> tuple[np.ndarray, np.ndarray]:
        """Every element as often as it occurs, each time under another name: (bag, name)."""
        owner = np.repeat(np.arange(len(bags)), [len(b[0]) for b in bags])
        value, count = (np.concatenate([b[k] for b in bags]) if bags else np.empty(0, np.int64) for k in (0, 1))
        item = np.repeat(np.arange(len(value)), count)
        turn = np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)
        return owner[item], mix64(value[item].astype(np.uint64) + turn.astype(np.uint64) * STEP)

    (own_x, name_x), (own_y, name_y) = items(x), items(y)
    common = np.intersect1d(name_x, name_y)
    out = np.zeros((len(x), len(y)), np.float64)
    sides = []
    for own, name in ((own_x, name_x), (own_y, name_y)):
        at = np.searchsorted(common, name)
        at[at == len(common)] = 0
        held = common[at] == name if len(common) else np.zeros(len(name), bool)
        order = np.argsort(at[held], kind="stable")
        sides.append((own[held][order], at[held][order]))
    for low in range(0, len(common), COLUMNS):
        width = min(COLUMNS, len(common) - low)
        dense = []
        for (own, at), n in zip(sides, (len(x), len(y))):
            a, b = np.searchsorted(at, (low, low + width))
            matrix = np.zeros((n, width), np.float32)
            matrix[own[a:b], at[a:b] - low] = 1.0
            dense.append(matrix)
        out += dense[0] @ dense[1].T
    return out


def compared(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """For the pairs (a, b): exact weighted Jaccard similarity, and the size of b."""

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, "text_b", 2_000_000):
            left = {k: i for i, k in enumerate(dict.fromkeys(frame["a"]))}
            bodies = dict(zip(frame["a"], frame["text_a"]))
            owner, value, count = shingles([find_words(bodies[k]) for k in left] + [find_words(x) for x in frame["text_b"]])
            cut = np.searchsorted(owner, np.arange(len(left) + len(frame) + 1))
            bags = [(value[s:e], count[s:e]) for s, e in zip(cut, cut[1:])]
            both = [(bags[left[a]], bags[len(left) + i]) for i, a in enumerate(frame["a"])]
            yield frame[["a", "b"]].assign(
                same=[overlap(x, y) for x, y in both],
                size=[int(y[1].sum()) for _, y in both],
            )

    joined = pairs.join(texts.select(F.col("node").alias("b"), F.col("body").alias("text_b")), "b")
    joined = joined.join(texts.select(F.col("node").alias("a"), F.col("body").alias("text_a")), "a")
    schema = "a binary, b binary, same double, size long"
    return joined.select("a", "b", "text_a", "text_b").mapInPandas(compare, schema)


def blocks_compared(left: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between the remaining members (bucket, node, root, main, rest, same, size) of buckets, as forests.

    ``main`` is the bucket's largest component, ``rest`` says that the member is outside it, ``same`` is its similarity
    to the leader.
    """
    # Blocks: large components by themselves, the others by the main component of their largest bucket; then the size
    # class, and as many parts as that needs.
    sizes = left.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    homes = left.join(sizes, "bucket").groupBy("node").agg(
        F.max(F.struct("n", "bucket", "main"))["main"].alias("main"), F.first("size").alias("size"), F.first("root").alias("root")
    )
    large = homes.groupBy("root").agg((F.count(F.lit(1)) >= LARGE).alias("large"))
    homes = homes.join(large, "root").withColumn("home", F.when(F.col("large"), F.col("root")).otherwise(F.col("main")))
    homes = homes.withColumn("step", F.floor(F.log("size") / -np.log(threshold) + 1e-9).cast("int"))
    homes = homes.join(texts.select("node", F.char_length("body").alias("chars")), "node")
    loads = homes.groupBy("large", "home", "step").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("chars") / BLOCK_CHARS)).alias("parts")
    )
    block = F.xxhash64("large", "home", "step", F.pmod(F.xxhash64("node"), F.col("parts"))).alias("block")
    homes = stage(homes.join(loads, ["large", "home", "step"]).select("node", "root", "step", block), "blocks")

    # Pairs of blocks that meet in a bucket and may hold a link.
    met = left.join(homes.select("node", "block", "step"), "node").groupBy("bucket", "block", "step").agg(
        F.max("rest").alias("rest"), F.min("same").alias("low"), F.max("same").alias("high"), F.min("root").alias("r0"), F.max("root").alias("r1")
    )
    met = stage(met, "blocks-met")
    x, y = met.alias("x"), met.alias("y")
    apart = 1 - threshold + 1e-9
    near = (F.col("x.low") - F.col("y.high") <= apart) & (F.col("y.low") - F.col("x.high") <= apart)
    one = (F.col("x.r0") == F.col("x.r1")) & (F.col("y.r0") == F.col("y.r1")) & (F.col("x.r0") == F.col("y.r0"))
    pairs = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.block") <= F.col("y.block")) & (F.abs(F.col("x.step") - F.col("y.step")) <= 1))
    pairs = pairs.where((F.col("x.rest") | F.col("y.rest")) & near & ~one).select(F.col("x.block").alias("p"), F.col("y.block").alias("q")).distinct()
    sides = F.when(F.col("p") == F.col("q"), F.array("p")).otherwise(F.array("p", "q"))
    wanted = pairs.select("p", "q", F.explode(sides).alias("block")).join(homes, "block").join(texts, "node")
    wanted = wanted.select("p", "q", (F.col("block") == F.col("p")).alias("first"), "node", "root", "body")

    def forest(nodes: list, roots: list, first: np.ndarray, bags: list, alone: bool) -> list[tuple]:
        xs = np.flatnonzero(first)
        ys = xs if alone else np.flatnonzero(~first)
        both = overlaps([bags[i] for i in xs], [bags[i] for i in ys])
        total = np.array([b[1].sum() for b in bags], np.float64)
        i, j = np.nonzero(both >= threshold * (total[xs][:, None] + total[ys][None, :] - both) - 1e-9)
        up: dict = {}

        def top(k):
            while up.get(k, k) != k:
                k = up[k]
            return k

        out = []
        for a, b in zip(xs[i].tolist(), ys[j].tolist()):
            s, t = top(roots[a]), top(roots[b])
            if s != t:
                up[max(s, t)] = min(s, t)
                out.append((nodes[a], nodes[b]))
        return out

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, ["p", "q"], "body", 4_000_000):
            owner, value, count = shingles([find_words(t) for t in frame["body"]])
            cut = np.searchsorted(owner, np.arange(len(frame) + 1))
            bags = [(value[s:e], count[s:e]) for s, e in zip(cut, cut[1:])]
            p, q, first = (frame[c].to_numpy() for c in ("p", "q", "first"))
            edge = np.flatnonzero((p[1:] != p[:-1]) | (q[1:] != q[:-1])) + 1
            nodes, roots = frame["node"].tolist(), frame["root"].tolist()
            out = []
            for s, e in zip([0, *edge.tolist()], [*edge.tolist(), len(frame)]):
                out += forest(nodes[s:e], roots[s:e], first[s:e].astype(bool), bags[s:e], p[s] == q[s])
            yield pd.DataFrame(out, columns=["a", "b"])

    ordered = wanted.repartition("p", "q").sortWithinPartitions("p", "q")
    return ordered.mapInPandas(compare, "a binary, b binary").distinct()


def whole_groups(frames: Iterator[pd.DataFrame], keys: list[str], column: str, characters: int) -> Iterator[pd.DataFrame]:
    """Sorted rows in frames of about ``characters`` of text that never split a group."""
    held: list[pd.DataFrame] = []
    size = 0
    for frame in frames:
        if not len(frame):
            continue
        same = (frame[keys].to_numpy()[1:] == frame[keys].to_numpy()[:-1]).all(axis=1)
        cuts = (np.flatnonzero(~same) + 1).tolist()
        for s, e in zip([0, *cuts], [*cuts, len(frame)]):
            part = frame.iloc[s:e]
            new = bool(held) and (held[-1][keys].iloc[-1] != part[keys].iloc[0]).any()
            if new and size >= characters:
                yield pd.concat(held, ignore_index=True)
                held, size = [], 0
            held.append(part)
            size += int(part[column].str.len().sum())
    if held:
        yield pd.concat(held, ignore_index=True)


def classes_and_groups(df: DataFrame, key: str, text: str, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Rows (id, node, bands) and, per node, ``class_id`` and ``group_id``."""
    rows = stage(sketched(df, key, text), "sketches")
    classes = stage(rows.groupBy("node").agg(F.min("id").alias("class_id"), F.first("bands", ignorenulls=True).alias("bands")), "classes")
    met = classes.select("node", F.explode("bands").alias("bucket"))
    shared = met.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stage(met.join(shared, "bucket"), "buckets")
    # A bucket's leader is the member that meets most others, over all buckets: of a text and its copies, the text.
    weights = members.groupBy("node").agg(F.sum("n").alias("weight"))
    leaders = members.join(weights, "node").groupBy("bucket").agg(F.max(F.struct("weight", "node"))["node"].alias("a"))
    members = stage(members.join(leaders, "bucket").where("node <> a").select("bucket", "a", "node"), "members")
    first = members.select("a", F.col("node").alias("b")).distinct()
    wanted = members.select("node").unionByName(members.select(F.col("a").alias("node"))).distinct()
    bodies = df.select(same_words(text_of(text)).alias("node"), text_of(text).alias("body"))
    texts = stage(bodies.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("body").alias("body")), "texts")
    tested = stage(compared(first, texts, threshold), "tested")
    links = tested.where(F.col("same") >= threshold).select("a", "b")
    roots = connected(links)

    # What is left: pairs of one bucket in different components, at least one outside the bucket's main component.
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    parts = placed.groupBy("bucket", "root").count().groupBy("bucket").agg(
        F.max(F.struct("count", "root"))["root"].alias("main"), F.count(F.lit(1)).alias("parts")
    )
    facts = tested.select("a", F.col("b").alias("node"), "same", "size")
    split = placed.join(parts.where("parts > 1"), "bucket").join(facts, ["a", "node"])
    left = stage(split.where(F.col("size") > 0).select("bucket", "node", "root", "main", (F.col("root") != F.col("main")).alias("rest"), "same", "size"), "split")
    more = stage(blocks_compared(left, texts, threshold), "links")
    if not more.isEmpty():
        roots = connected(links.unionByName(more))

    named = classes.select("node", "class_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    groups = named.groupBy("root").agg(F.min("class_id").alias("group_id"))
    return rows, named.join(groups, "root").select("node", "class_id", "root", "group_id")


def near_duplicates(df: DataFrame, *, key: str = "doc_id", text: str = "text", threshold: float = 0.8) -> DataFrame:
    """Per row: key, ``class_id`` (smallest id with the same words), ``group_id`` (smallest id of the linked classes), ``kept``."""
    rows, found = classes_and_groups(df, key, text, threshold)
    kept = F.col("id").eqNullSafe(F.col("group_id")).alias("kept")
    return rows.join(found, "node").select(F.col("id").alias(key), "class_id", "group_id", kept)


def one_of_each(df: DataFrame, *, key: str = "doc_id", text: str = "text", threshold: float = 0.8) -> DataFrame:
    """The rows of ``df`` that stay, with all their columns: of every group one with its smallest id.

    Of several such rows the one with the smallest hash of its text stays, of equal ones the first as it was written.
    """
    mark, number = fresh(df, "node", "number")
    df = stage(df.withColumn(number, F.monotonically_increasing_id()), "rows")
    _, found = classes_and_groups(df, key, text, threshold)
    rows = df.withColumn(mark, same_words(text_of(text))).alias("d")
    least = F.col(f"d.`{key}`").eqNullSafe(F.col("g.group_id"))
    joined = rows.join(found.alias("g"), (F.col(f"d.`{mark}`") == F.col("g.node")) & least)
    stays = joined.groupBy("g.root").agg(F.min(F.struct(F.xxhash64(text_of(text)).alias("print"), F.col(f"d.`{number}`").alias("number")))["number"].alias("stays"))
    return df.join(stays, F.col(f"`{number}`") == F.col("stays"), "left_semi").drop(number)
