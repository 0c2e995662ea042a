"""Windows of fixed length that occur again, found through anchors: the part shared by the two substring operators.

An operator picks for every window one anchor that depends on the window's content only, so equal windows have equal
anchor keys at equal places.  The job then runs in steps, and only what recurs moves on:

1. Every text's distinct anchor keys are gathered.  A task first settles what recurs among its own texts: of a key it
   sends one entry to the key's partition, whatever the number of its texts, and the others, already known to recur, to
   partitions by text.  So a key that a third of all texts share adds one entry per task.
2. Texts with recurring keys get them back and give the stretches around those anchors, the contexts.  Documents with
   equal texts are one class here, for which the one with the smallest id stands; its copies are answered by counting.
3. Equal contexts are counted and collapsed before they meet; the operator compares the distinct contexts of a key and
   says which of their windows recur.  A key with very many distinct contexts is split: its windows are counted by their
   content, on as many tasks as there are.
4. The answers join the documents again and become spans.

A text travels compressed, and twice at most.  What a finished step has shuffled is given up before the next.
"""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siftwork.llm.common import U64, mix64, signed, slices, small, text_of
from siftwork.sources.shared import shared_path, stage

ENTRIES = 1_000_000
GATHER = 25_000
JUDGED = 8_000  # distinct contexts judged at once, or a key
HOT, HOT_SHARE = 400, 1_500  # a key is split by window from so many distinct contexts, and such a part of all, on
SHORT = (1 << 40) - 1  # two texts that share a key are taken for one with a probability of 1e-12
# Per batch of texts: number of the text, anchor key, first window, last window + 1, place of the anchor.
Anchors = Callable[[list[str]], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def documents(df: DataFrame, key: str, text: str) -> DataFrame:
    """Id (a null one after all others), two fingerprints of the text, and the text (null: empty)."""
    number = F.coalesce(F.col(f"`{key}`").cast("long"), F.lit((1 << 63) - 1))
    body = text_of(text)
    return df.select(number.alias("id"), F.xxhash64(body).alias("print"), F.unhex(F.md5(body.cast("binary"))).alias("digest"), body.alias("body"))


def text_classes(docs: DataFrame) -> DataFrame:
    """Equal texts: digest, print, smallest id, number of documents."""
    return stage(docs.groupBy("digest", "print").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("copies")), "classes")


def give_up_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of plans that are no longer held; it does so when the driver collects garbage.

    The first collection frees what Python held, the second what hung on that.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(1)


def planes(values: np.ndarray) -> bytes:
    """64-bit values with their bytes sorted by place, which compresses well for sorted or small values."""
    return np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def unplanes(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, -1).T).view("<i8").ravel()


def settled(ids: np.ndarray, keys: np.ndarray, several: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries sorted by key, then document; marks those whose key recurs, and the first of each key."""
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    start = np.flatnonzero(first)
    size = np.diff(np.append(start, len(keys)))
    again = np.logical_or.reduceat(several, start) | (size > 1) if len(start) else np.zeros(0, bool)
    return np.repeat(again, size), first


def recurring(docs: DataFrame, anchors: Anchors, same_document: bool, partitions: int) -> DataFrame:
    """(print, keys): per text (the last 40 bits of its print) the anchor keys that other texts have too, or that it has twice (``same_document``)."""

    def entries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for frame in slices(frames, "body", 1_500_000):
            ids = frame["print"].to_numpy(np.int64) & SHORT
            owner, key, *_ = anchors(frame["body"].tolist())
            order = np.lexsort((key, owner))
            owner, key = owner[order], key[order]
            new = np.ones(len(key), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])
            at = np.flatnonzero(new)
            times = np.diff(np.append(at, len(key)))
            held.append((ids[owner[at]], key[at], (times > 1) & same_document))
            if sum(len(x[0]) for x in held) >= ENTRIES:
                yield flush(held)
                held = []
        if held:
            yield flush(held)

    def flush(held: list) -> pd.DataFrame:
        ids, keys, several = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((ids, keys))
        ids, keys, several = ids[order], keys[order], several[order]
        new = np.ones(len(keys), bool)  # copies of a text are one
        new[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
        ids, keys, several = ids[new], keys[new], several[new]
        again, first = settled(ids, keys, several)
        # One entry stands for the key; the rest are settled and go wherever there is room.
        room = np.where(first, mix64(keys), mix64(ids.view(np.uint64) + U64(77))) % U64(partitions)
        order = np.argsort(room, kind="stable")
        cut = np.searchsorted(room[order], np.arange(partitions + 1))
        rows = [
            (p, planes(ids[o]), planes(signed(keys[o])), np.packbits(again[o]).tobytes(), np.packbits(first[o]).tobytes())
            for p in range(partitions)
            if len(o := order[cut[p] : cut[p + 1]])
        ]
        return pd.DataFrame(rows, columns=["room", "ids", "keys", "again", "first"])

    def answers(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, keys, again = [], [], []
        for frame in frames:
            for row in frame.itertuples(index=False):
                i, k = unplanes(row.ids), unplanes(row.keys).view(np.uint64)
                a = np.unpackbits(np.frombuffer(row.again, np.uint8), count=len(i)).astype(bool)
                f = np.unpackbits(np.frombuffer(row.first, np.uint8), count=len(i)).astype(bool)
                yield pd.DataFrame({"print": i[~f], "key": signed(k[~f])})
                ids.append(i[f]), keys.append(k[f]), again.append(a[f])
        if ids:
            i, k, a = np.concatenate(ids), np.concatenate(keys), np.concatenate(again)
            room = k % U64(16)
            for part in range(16):  # bounds what is sorted at once
                mine = room == U64(part)
                order = np.lexsort((i[mine], k[mine]))
                pi, pk, pa = i[mine][order], k[mine][order], a[mine][order]
                new = np.ones(len(pk), bool)
                new[1:] = (pk[1:] != pk[:-1]) | (pi[1:] != pi[:-1])
                at = np.flatnonzero(new)
                known = np.logical_or.reduceat(pa, at) if len(at) else pa
                yes, _ = settled(pi[at], pk[at], known)
                yield pd.DataFrame({"print": pi[at][yes], "key": signed(pk[at][yes])})

    sent = docs.select("print", "body").mapInPandas(entries, "room int, ids binary, keys binary, again binary, first binary")
    return dealt(sent, partitions).mapInPandas(answers, "print long, key long").groupBy("print").agg(F.collect_set("key").alias("keys"))


def dealt(sent: DataFrame, partitions: int) -> DataFrame:
    """A partition per room; by a hash of the room some tasks would get several and a third of them none."""
    return sent.repartitionById(partitions, "room")


def zipped(docs: DataFrame) -> DataFrame:
    """The documents with compressed texts."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        press = zstandard.ZstdCompressor(level=3)
        for frame in slices(frames, "body"):
            yield frame.assign(body=[press.compress(x.encode("utf-8", "surrogatepass")) for x in frame["body"]])

    return docs.mapInPandas(pack, "id long, print long, digest binary, body binary")


def unzipped(blobs: pd.Series) -> list[str]:
    import zstandard

    opener = zstandard.ZstdDecompressor()
    return [opener.decompress(x).decode("utf-8", "surrogatepass") for x in blobs]


def contexts(
    docs: DataFrame, classes: DataFrame, keys: DataFrame, anchors: Anchors, cut: Callable[[list[str]], Callable[[int, int, int], bytes]]
) -> DataFrame:
    """One row per anchor with a recurring key: key, id, print, first window, place of the anchor in the stretch, the stretch."""

    def around(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small(frames, 400):
            texts = unzipped(frame["body"])
            owner, key, start, stop, place = anchors(texts)
            order = np.argsort(owner, kind="stable")
            owner, key, start, stop, place = owner[order], key[order], start[order], stop[order], place[order]
            known = [np.sort(np.asarray(k, np.int64).view(np.uint64)) for k in frame["keys"]]
            sizes = np.array([len(k) for k in known])
            # All documents' wanted keys in one sorted list, told apart by the document.
            wanted = np.sort(mix64(np.concatenate(known) + np.repeat(np.arange(len(known)).astype(np.uint64), sizes) * U64(0x9E3779B97F4A7C15)))
            mine = mix64(key + owner.astype(np.uint64) * U64(0x9E3779B97F4A7C15))
            at = np.searchsorted(wanted, mine)
            at[at == len(wanted)] = 0
            hit = np.flatnonzero(wanted[at] == mine)
            piece = cut(texts)
            own = owner[hit]
            yield pd.DataFrame(
                {
                    "key": signed(key[hit]),
                    "id": frame["id"].to_numpy()[own],
                    "print": frame["print"].to_numpy()[own],
                    "start": start[hit].astype(np.int32),
                    "lead": (place[hit] - start[hit]).astype(np.int32),
                    "body": [piece(o, s, e) for o, s, e in zip(own.tolist(), start[hit].tolist(), stop[hit].tolist())],
                }
            )

    short = classes.select(F.col("print").bitwiseAND(SHORT).alias("print"), F.col("low").alias("id"), "digest")
    wanted = keys.join(short, "print").select("id", "digest", "keys")
    joined = zipped(docs).join(wanted, ["id", "digest"]).select("id", "print", "body", "keys")
    rows = joined.mapInPandas(around, "key long, id long, print long, start int, lead int, body binary")
    spark, path = docs.sparkSession, shared_path(docs.sparkSession, "contexts")
    rows.withColumn("mark", F.xxhash64("body", "lead")).write.option("compression", "zstd").parquet(path)
    del wanted, joined, rows, keys
    give_up_shuffles(spark)
    return spark.read.parquet(path)


def hot_from(rows: int) -> int:
    """Number of distinct contexts from which a key is hot, among ``rows`` of them.

    It grows with the table, so that the same share of it is split by window at every size, up to what a task gathers anyway.
    """
    return max(HOT, min(GATHER, rows // HOT_SHARE))


def hot_keys(distinct: DataFrame) -> DataFrame:
    """Keys with more than about ``hot_from`` distinct contexts, by a sample of the marks.

    Only the way to a key's answers depends on it, not the answers.  There are at most ``HOT_SHARE`` or rows / ``GATHER``
    such keys.
    """
    least = hot_from(distinct.count())
    every = max(1, least // 250)
    some = distinct.where(F.pmod(F.col("mark"), F.lit(every)) == 0).select("key", "mark").distinct()
    return stage(some.groupBy("key").count().where(F.col("count") * every > least).select("key"), "hot")


def distinct_contexts(found: DataFrame) -> DataFrame:
    """Equal contexts as one row with the smallest id and their number; written, so that their shuffle can go."""
    spark, path = found.sparkSession, shared_path(found.sparkSession, "distinct")
    rows = found.groupBy("key", "mark", "lead", "body").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("times"))
    rows.write.option("compression", "zstd").parquet(path)
    del rows
    give_up_shuffles(spark)
    return spark.read.parquet(path)


def judged(found: DataFrame, judge: Callable[[pd.DataFrame], pd.DataFrame], windows: Callable[[bytes], list[bytes]], partitions: int) -> DataFrame:
    """Distinct contexts to ``judge`` (key, mark, lead, body, first id, number), whole keys at a time; returns its answers.

    Answers: key, mark, froms, tos (windows of the context), lows (smallest id that has those windows).  Hot keys are
    judged by the contents of their ``windows`` instead.  The answers are written, so that the contexts' shuffles are gone
    before the answers meet the contexts again.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            last = held["key"].iloc[-1]
            if len(held) >= min(GATHER, JUDGED) and held["key"].iloc[0] != last:
                whole = (held["key"] != last).to_numpy()
                yield judge(held[whole].reset_index(drop=True))
                held = held[~whole].reset_index(drop=True)
        if held is not None and len(held):
            yield judge(held.reset_index(drop=True))

    distinct = distinct_contexts(found)
    hot = hot_keys(distinct)
    split = not hot.isEmpty()
    cold = distinct.join(F.broadcast(hot), "key", "left_anti") if split else distinct
    ordered = cold.repartition(partitions, "key").sortWithinPartitions("key")
    out = ordered.mapInPandas(run, "key long, mark long, froms array<int>, tos array<int>, lows array<long>")
    if split:
        out = out.unionByName(judged_by_window(distinct.join(F.broadcast(hot), "key", "left_semi"), windows))
    written = stage(out, "answers")
    del out, ordered, cold, hot
    give_up_shuffles(written.sparkSession)
    return written


def judged_by_window(distinct: DataFrame, windows: Callable[[bytes], list[bytes]]) -> DataFrame:
    """The same answers, from counts per key, place of the anchor in the window, and content; no task holds a key."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small(frames):
            pieces = [windows(x) for x in frame["body"]]
            owner = np.repeat(np.arange(len(pieces)), [len(x) for x in pieces])
            inside = np.concatenate([np.arange(len(x), dtype=np.int32) for x in pieces])
            rows = frame[["key", "mark", "low", "times"]].iloc[owner].reset_index(drop=True)
            place = frame["lead"].to_numpy(np.int32)[owner] - inside
            yield rows.assign(inside=inside, place=place, window=[w for x in pieces for w in x])

    cells = stage(distinct, "hot-contexts").mapInPandas(cut, "key long, mark long, low long, times long, inside int, place int, window binary")
    same = ["key", "place", "window"]
    sums = cells.groupBy(*same).agg(F.min("low").alias("low"), F.sum("times").alias("times"), F.count(F.lit(1)).alias("n"))
    again = stage(sums.where("times > 1").select(*same, "low", "n"), "hot-windows")
    # What is inside a passage is shared by most contexts of its key: such windows, at most rows / GATHER, go to all tasks.
    common, rare = F.broadcast(again.where(F.col("n") > GATHER).drop("n")), again.where(F.col("n") <= GATHER).drop("n")
    mine = cells.drop("low", "times")
    hits = mine.join(common, same).unionByName(mine.join(common, same, "left_anti").join(rare, same))
    runs = hits.groupBy("key", "mark").agg(F.sort_array(F.collect_list(F.struct("inside", "low"))).alias("hits"))

    def apart(x: Column, y: Column) -> Column:
        return F.coalesce((x["inside"] + 1 != y["inside"]) | (x["low"] != y["low"]), F.lit(True))

    h = F.col("hits")
    first = F.filter(h, lambda x, i: (i == 0) | apart(F.get(h, i - 1), x))
    last = F.filter(h, lambda x, i: apart(x, F.get(h, i + 1)))
    return runs.select(
        "key",
        "mark",
        F.transform(first, lambda x: x["inside"]).alias("froms"),
        F.transform(last, lambda x: x["inside"] + 1).alias("tos"),
        F.transform(first, lambda x: x["low"]).alias("lows"),
    )


def spans(found: DataFrame, answers: DataFrame, wanted: Column) -> DataFrame:
    """Per document the recurring windows as ranges (from, to) of window starts; ``wanted`` tests a range's ``low``."""
    ranges = F.explode(F.arrays_zip("froms", "tos", "lows")).alias("r")
    rows = found.select("key", "mark", "id", "print", "start").join(answers, ["key", "mark"]).select("id", "print", "start", ranges)
    rows = rows.select("id", "print", "start", "r.froms", "r.tos", F.col("r.lows").alias("low")).where(wanted)
    window = F.struct((F.col("start") + F.col("froms")).alias("a"), (F.col("start") + F.col("tos")).alias("b"))
    out = stage(rows.groupBy("id", "print").agg(F.collect_set(window).alias("spans")), "spans")
    del rows, answers, found
    give_up_shuffles(out.sparkSession)
    return out


def stretches(windows: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal covered ranges of units, from ranges (from, to) of window starts."""
    if not len(windows):
        return []
    windows = windows[np.argsort(windows[:, 0], kind="stable")]
    begin, end = windows[:, 0], np.maximum.accumulate(windows[:, 1] - 1 + length)
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > end[:-1]
    at = np.flatnonzero(new)
    return list(zip(begin[at].tolist(), end[np.append(at[1:] - 1, len(end) - 1)].tolist()))


def applied(
    docs: DataFrame, classes: DataFrame, found: DataFrame, copied: Column, finish: Callable[[str, list, bool], tuple], length: int, schema: str, names: list[str]
) -> DataFrame:
    """Every document with its spans, put through ``finish``; ``copied`` (from id, low, copies) says that all of it recurs."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small(frames):
            out = []
            for body, ranges, whole in zip(unzipped(frame["body"]), frame["spans"], frame["whole"]):
                windows = np.array([(r["a"], r["b"]) for r in ranges] if ranges is not None else [], np.int64).reshape(-1, 2)
                out.append(finish(body, stretches(windows, length), whole))
            yield pd.concat([frame[["id"]].reset_index(drop=True), pd.DataFrame(out, columns=names)], axis=1)

    spanned = classes.join(found.withColumnRenamed("id", "low"), ["low", "print"], "left").select("digest", "low", "copies", "spans")
    rows = zipped(docs).join(spanned, "digest").select("id", "body", "spans", copied.alias("whole"))
    return rows.mapInPandas(run, f"id long, {schema}")


def partitions_of(docs: DataFrame) -> int:
    return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def grouped_runs(flags: np.ndarray, owner: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of maximal runs of flagged neighbours with the same owner and value."""
    n = len(flags)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = np.zeros(n, bool)
    same[1:] = flags[1:] & flags[:-1] & (owner[1:] == owner[:-1]) & (values[1:] == values[:-1])
    starts = np.flatnonzero(flags & ~same)
    ends = np.flatnonzero(flags & ~np.append(same[1:], False)) + 1
    return starts, ends
