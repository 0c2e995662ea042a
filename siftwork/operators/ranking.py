"""Seeded random order without a sort: rank cuts on a key hash.

Rows are ordered by ``md5(seed:key)`` inside each stratum.  Sampling, splitting
and fold assignment only need to know *where* a few ranks fall, so the hash at
each cut rank is located by counting hash prefixes (one narrow aggregate per
four hex digits) and the table itself is then labelled by comparing hashes:
no window over a class, no shuffle of the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from siftwork.functions.columns import col

PREFIX_STEP = 4
BUCKET_ROWS = 50_000
MAX_STRATA = 10_000


def key_hash(keys: Sequence[str], seed: int) -> Column:
    """32 hex digits that depend on the seed and the key only, on any engine."""
    parts = [col(k).cast("string") for k in keys]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def stratum_sizes(df: DataFrame, stratum: str | None) -> dict:
    """Rows per stratum (one map-side combined aggregate); the number of strata is checked."""
    if stratum is None:
        return {None: df.count()}
    rows = df.groupBy(col(stratum).alias("s")).count().limit(MAX_STRATA + 1).collect()
    if len(rows) > MAX_STRATA:
        raise ValueError(f"more than {MAX_STRATA} strata in column {stratum!r}")
    return {r["s"]: r["count"] for r in rows}


def largest_remainder(counts: Mapping, total: int) -> dict:
    """Split ``total`` in proportion to ``counts``; ties go to the first class in order."""
    n = sum(counts.values())
    ordered = sorted(counts, key=lambda k: (k is not None, k))
    share = {k: counts[k] * total // n for k in ordered}
    spare = total - sum(share.values())
    by_remainder = sorted(ordered, key=lambda k: -(counts[k] * total % n))
    for k in by_remainder[:spare]:
        share[k] += 1
    return share


def _small(df: DataFrame, rows: list, schema: str) -> DataFrame:
    """Rows whose number is bounded by strata x cuts; safe to broadcast."""
    return F.broadcast(df.sparkSession.createDataFrame(rows, schema))


def cut_hashes(
    df: DataFrame, keys: Sequence[str], cuts: Mapping, sizes: Mapping, stratum: str | None, seed: int
) -> dict:
    """Hash at each zero-based cut rank: ``{stratum: {rank: (hash, copies)}}``.

    ``cuts`` maps a stratum to ranks in ``1 .. size-1``. ``copies`` is the number
    of rows with that same hash before the cut: 0 when the key identifies rows.
    """
    s = col(stratum).alias("s") if stratum is not None else F.lit(None).cast("string").alias("s")
    narrow = df.select(s, key_hash(keys, seed).alias("h"))
    s_type = dict(narrow.dtypes)["s"]
    target = [(k, r, "", r) for k, ranks in cuts.items() for r in sorted(set(ranks))]
    if not target:
        return {k: {} for k in cuts}
    largest = max(sizes[k] for k, *_ in target)
    digits = 0
    while largest > BUCKET_ROWS and digits < 32:
        schema = f"ts {s_type}, cut bigint, prefix string, rest bigint"
        open_buckets = _small(narrow, sorted({(t[0], t[2]) for t in target}, key=str), f"bs {s_type}, prefix string")
        inside = narrow.join(
            open_buckets,
            narrow["s"].eqNullSafe(open_buckets["bs"]) & (F.substring("h", 1, digits) == open_buckets["prefix"])
            if digits
            else narrow["s"].eqNullSafe(open_buckets["bs"]),
            "left_semi",
        )
        digits += PREFIX_STEP
        counted = inside.groupBy(
            "s", F.substring("h", 1, digits - PREFIX_STEP).alias("outer"), F.substring("h", 1, digits).alias("p")
        ).count()
        # At most 16^4 rows per open bucket reach this window, whatever the table holds.
        w = Window.partitionBy("s", "outer").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
        running = counted.withColumn("before", F.coalesce(F.sum("count").over(w), F.lit(0)))
        wanted = _small(narrow, target, schema)
        hit = running.join(
            wanted,
            running["s"].eqNullSafe(wanted["ts"])
            & (running["outer"] == wanted["prefix"])
            & (wanted["rest"] >= running["before"])
            & (wanted["rest"] < running["before"] + running["count"]),
        ).select("ts", "cut", "p", (F.col("rest") - F.col("before")).alias("rest"), "count")
        rows = hit.collect()
        target = [(r["ts"], r["cut"], r["p"], r["rest"]) for r in rows]
        largest = max(r["count"] for r in rows)
    result: dict = {k: {} for k in cuts}
    if largest > BUCKET_ROWS:
        # All 32 digits are used up: every open bucket is one key, however many rows share it.
        for k, cut, h, rest in target:
            result[k][cut] = (h, rest)
        return result
    buckets = _small(narrow, sorted({(t[0], t[2]) for t in target}, key=str), f"bs {s_type}, prefix string")
    condition = narrow["s"].eqNullSafe(buckets["bs"])
    if digits:
        condition = condition & (F.substring("h", 1, digits) == buckets["prefix"])
    inside = narrow.join(buckets, condition)
    w = Window.partitionBy("bs", "prefix").orderBy("h")
    ranked = inside.select(
        "bs", "prefix", "h", (F.row_number().over(w) - 1).alias("rank"), (F.rank().over(w) - 1).alias("first")
    )
    wanted = _small(narrow, target, f"ts {s_type}, cut bigint, tp string, rest bigint")
    found = ranked.join(
        wanted,
        ranked["bs"].eqNullSafe(wanted["ts"])
        & (ranked["prefix"] == wanted["tp"])
        & (ranked["rank"] == wanted["rest"]),
    ).select("ts", "cut", "h", (F.col("rank") - F.col("first")).alias("copies"))
    for r in found.collect():
        result[r["ts"]][r["cut"]] = (r["h"], r["copies"])
    return result


def label_by_quota(
    df: DataFrame,
    keys: Sequence[str],
    quotas: Mapping,
    sizes: Mapping,
    labels: Sequence,
    stratum: str | None = None,
    seed: int = 42,
    out: str = "part",
    label_type: str = "string",
) -> DataFrame:
    """Give the first ``quotas[stratum][0]`` rows of the random order the first label, and so on.

    ``keys`` should identify a row: rows sharing a key share a hash and land together,
    after the cut that would divide them.
    """
    edges = {}
    for k, parts in quotas.items():
        total, ends = 0, []
        for q in parts:
            total += q
            ends.append(total)
        edges[k] = ends
    hashes = cut_hashes(
        df, keys, {k: [e for e in ends if 0 < e < sizes[k]] for k, ends in edges.items()}, sizes, stratum, seed
    )

    def bounds(k) -> list[str]:
        # 'g' sorts after every hex digit, '' before: an empty or a full part needs no hash.
        return ["" if e <= 0 else "g" if e >= sizes[k] else hashes[k][e][0] for e in edges[k]]

    names = F.array(*[F.lit(x).cast(label_type) for x in labels])
    hashed = df.withColumn("__hash", key_hash(keys, seed))

    def pick(ends: Column) -> Column:
        passed = sum(((ends[i] <= F.col("__hash")).cast("int") for i in range(len(labels))), F.lit(1))
        return F.try_element_at(names, passed)

    if stratum is None:
        ends = F.array(*[F.lit(b) for b in bounds(None)])
        return hashed.withColumn(out, pick(ends)).drop("__hash")
    s_type = dict(df.select(col(stratum).alias("s")).dtypes)["s"]
    table = _small(df, [(k, bounds(k)) for k in edges], f"__s {s_type}, __ends array<string>")
    return (
        hashed.join(table, col(stratum).eqNullSafe(F.col("__s")), "left")
        .withColumn(out, pick(F.col("__ends")))
        .drop("__s", "__ends", "__hash")
    )
