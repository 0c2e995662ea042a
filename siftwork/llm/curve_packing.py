"""Packing along a space-filling curve.

Every document becomes a hashed bag of token ids, projected to a few dimensions.  The dimensions are brought to a common
scale (mean and deviation over all documents), cut to a grid and numbered along a Hilbert curve, so that documents with
similar content get close keys.  Spark range-sorts the documents by key, and each range is written out as one stream
that is cut every ``capacity`` tokens.  What is left at the end of a range is cut into sequences whose sizes are powers
of two, so that nothing needs padding.

Equal keys are ordered by id and then by token ids, so ties and repeated rows have a fixed place.  Ranges are cut by key
and id, so a large group of copies does not end up in one task.  Null texts are empty and still get the
closing id.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from siftwork.llm.common import mix64, slices, small, text_of
from siftwork.llm.tokens import byte_tokenizer, tokenizer_path
from siftwork.sources.shared import stage

BUCKETS = 256
DIMENSIONS = 4
BITS = 12


def projection(seed: int = 42) -> np.ndarray:
    """Random directions from hash buckets to a few dimensions, the same in every process."""
    return np.random.default_rng(seed).standard_normal((BUCKETS, DIMENSIONS))


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each grid cell (rows of non-negative integers below 2**bits) on the Hilbert curve.

    The axes are turned and reflected level by level so that the cells of each sub-cube are met in Gray-code order.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        below = level - 1
        for i in range(n):
            high = (x[i] & level) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & below)
            x[0] = np.where(high, x[0] ^ below, x[0] ^ swap)
            x[i] ^= swap
        level >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        turn ^= np.where((x[n - 1] & level) != 0, level - 1, 0)
        level >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def encoded(df: DataFrame, key: str, text: str, tokenizer: str, end_id: int) -> DataFrame:
    """Per document: id, token ids with the closing one (two or four bytes each, compressed), their number, projections."""

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        model = byte_tokenizer(tokenizer_path(tokenizer))
        kind = "<u2" if max(model.size, end_id + 1) <= 65536 else "<u4"
        bucket = (mix64(np.arange(1, max(model.size, end_id + 1) + 1, dtype=np.uint64)) % np.uint64(BUCKETS)).astype(np.int64)
        axes, packer = projection(), zstandard.ZstdCompressor(level=1)
        for frame in slices(frames, "body"):
            counts = np.zeros((len(frame), BUCKETS))
            blobs, sizes = [], []
            for i, body in enumerate(frame["body"]):
                ids = np.append(model.ids(body), np.uint32(end_id))
                counts[i] = np.bincount(bucket[ids], minlength=BUCKETS)
                sizes.append(len(ids))
                blobs.append(kind[2:].encode() + packer.compress(ids.astype(kind).tobytes()))
            weights = np.log1p(counts)
            weights /= np.linalg.norm(weights, axis=1, keepdims=True)
            place = weights @ axes
            yield pd.DataFrame({"id": frame["id"], "tokens": sizes, "ids": blobs, **{f"x{i}": place[:, i] for i in range(DIMENSIONS)}})

    rows = df.select(F.col(f"`{key}`").alias("id"), text_of(text).alias("body"))
    axes = ", ".join(f"x{i} double" for i in range(DIMENSIONS))
    return rows.mapInPandas(encode, f"id {df.schema[key].dataType.simpleString()}, tokens long, ids binary, {axes}")


def with_curve_key(documents: DataFrame) -> DataFrame:
    """Adds ``curve``: the projections scaled by their mean and deviation over all rows, as a place on the curve."""
    axes = [f"x{i}" for i in range(DIMENSIONS)]
    spread = documents.agg(*[f(c).alias(f"{n}_{c}") for c in axes for n, f in (("m", F.mean), ("s", F.stddev_pop))]).first()
    mean = np.array([spread[f"m_{c}"] or 0.0 for c in axes])
    width = np.array([spread[f"s_{c}"] or 1.0 for c in axes])

    @F.pandas_udf("long")
    def place(*x: pd.Series) -> pd.Series:
        z = (np.stack([c.to_numpy() for c in x], axis=1) - mean) / width
        # A smooth rank of a bell-shaped spread: all cells of the grid get a similar share.
        share = 1.0 / (1.0 + np.exp(-1.702 * z))
        cells = np.clip((share * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
        return pd.Series(hilbert_keys(cells))

    return documents.withColumn("curve", place(*axes))


PIECE = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]


def cut_stream(frames: Iterator[pd.DataFrame], capacity: int) -> Iterator[pd.DataFrame]:
    """Pieces of a sorted range: documents one after the other, cut every ``capacity`` tokens.

    The pieces of the open sequence are held until it is full.  What is left at the end is cut into powers of two.
    """
    import zstandard

    unpacker = zstandard.ZstdDecompressor()
    held: list[tuple] = []
    sequence, used, number = 0, 0, 0

    def written(pieces: list[tuple], sequence: int) -> Iterator[tuple]:
        offset = 0
        for key, start, ids, total in pieces:
            body = ids.tobytes()
            yield key, start, len(ids), zlib.crc32(body), total, (number << 40) | sequence, offset, body
            offset += len(ids)

    for frame in small(frames, 500):
        out: list[tuple] = []
        for row in frame.itertuples(index=False):
            number = int(row.range)
            ids = np.frombuffer(unpacker.decompress(row.ids[1:]), f"<u{int(row.ids[:1])}").astype("<u4")
            start = 0
            while start < len(ids):
                size = min(len(ids) - start, capacity - used)
                held.append((row.id, start, ids[start : start + size], len(ids)))
                start, used = start + size, used + size
                if used == capacity:
                    out.extend(written(held, sequence))
                    held, used, sequence = [], 0, sequence + 1
        yield pd.DataFrame(out, columns=PIECE)
    out = []
    while used:
        size, taken = 1 << (used.bit_length() - 1), []
        used -= size
        while size:
            key, start, ids, total = held.pop(0)
            if len(ids) > size:
                held.insert(0, (key, start + size, ids[size:], total))
            taken.append((key, start, ids[:size], total))
            size -= len(taken[-1][2])
        out.extend(written(taken, sequence))
        sequence += 1
    yield pd.DataFrame(out, columns=PIECE)


def pack(
    df: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str = "byte_bpe_50k.json",
    end_id: int = 1,
    capacity: int = 2048,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence, and (``with_ids``) its token ids.

    Ids are little-endian unsigned 32-bit numbers in ``ids``.  ``sequence_id`` is the range's number and the sequence's
    within it.
    """
    documents = with_curve_key(stage(encoded(df, key, text, tokenizer, end_id), "packing"))
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = (
        documents.select("id", "curve", "ids")
        .repartitionByRange(partitions, "curve", "id")
        .sortWithinPartitions("curve", "id", "ids")
        .select("id", "ids", F.spark_partition_id().alias("range"))
    )
    kind = df.schema[key].dataType.simpleString()
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    out = ranges.mapInPandas(
        lambda frames: (f if with_ids else f.drop(columns="ids") for f in cut_stream(frames, capacity)),
        schema + (", ids binary" if with_ids else ""),
    )
    return out.withColumnRenamed("id", key)
