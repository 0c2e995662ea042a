"""Line deduplication by a log-template tree of fixed depth.

A line goes down the tree by its number of tokens and its leading tokens; tokens with a digit count as variable fields
everywhere.  Within a leaf, a token stays constant at its place if at least ``min_docs`` pairs of document and line have
it there; other tokens are generalised to a field.  Lines with the same constants share a template.  A template may
generalise at most ``max_fields`` of its tokens and must keep at least half of them as constants, otherwise the line has
none.  A template found in ``min_docs`` documents is recurring.  A line that is the same token for token in ``min_same``
documents is recurring too, whatever its tokens are.  Recurring lines are dropped from all documents but the one with
the smallest id, so nothing said in the corpus is lost altogether.

Only counts are gathered per leaf, never lines.  Leaves and lines are known by 128-bit hashes.  A leaf seen in fewer
documents cannot hold a recurring template, and its lines leave the job before anything else is done with them.  Lines
are parsed in Arrow batches, once for the counts, and once more for the tokens of the leaves that are left: that is
cheaper than to write all lines out.

Lines without a token are kept and count for nothing.  Null texts stay null, empty ones empty.  Null ids come after all
others; if a template or line has only such rows they all keep it.  Rows with the same id and text are one document and
get the same result.  Other columns pass through, whatever their names.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from siftwork.llm.common import find_words, fresh
from siftwork.sources.shared import stage

FIELD = "<*>"
DEPTH = 3
DIGIT = re.compile("[0-9]")
BATCH_BYTES = 8_000_000


def masked(token: Column) -> Column:
    return F.when(token.rlike("[0-9]"), F.lit(FIELD)).otherwise(token)


def documents(df: DataFrame, key: str, text: str) -> DataFrame:
    """Id, digest and text; equal rows once."""
    body = F.col(f"`{text}`").cast("string")
    return df.select(F.col(f"`{key}`").alias("id"), F.unhex(F.md5(body.cast("binary"))).alias("digest"), body.alias("body"))


def leaf_of(words: list[str]) -> str:
    """The way down the tree: number of tokens and leading tokens."""
    return "\n".join([str(len(words)), *[FIELD if DIGIT.search(w) else w for w in words[:DEPTH]]])


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``BATCH_BYTES`` of text each, or a single row."""
    size = pc.fill_null(pc.binary_length(batch.column("body")), 0).to_numpy(zero_copy_only=False)
    edges = np.flatnonzero(np.diff(np.cumsum(size, dtype=np.int64) // BATCH_BYTES)) + 1
    for start, stop in zip([0, *edges.tolist()], [*edges.tolist(), len(size)]):
        yield batch.slice(start, stop - start)


def parsed(rows: DataFrame, whole: bool) -> DataFrame:
    """Lines with at least one token: id, digest, number and leaf, and the line's hash or (``whole``) its tokens."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        def print_of(text: str) -> bytes:
            return xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))

        for batch in batches:
            for piece in pieces(batch):
                owner, number, leaf, line = [], [], [], []
                for i, body in enumerate(piece.column("body").to_pylist()):
                    for k, raw in enumerate((body or "").split("\n")):
                        words = find_words(raw)
                        if words:
                            owner.append(i)
                            number.append(k)
                            leaf.append(print_of(leaf_of(words)))
                            line.append(" ".join(words) if whole else print_of(" ".join(words)))
                at = pa.array(owner, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("id").take(at),
                        piece.column("digest").take(at),
                        pa.array(number, pa.int32()),
                        pa.array(leaf, pa.binary()),
                        pa.array(line, pa.string() if whole else pa.binary()),
                    ],
                    names=["id", "digest", "no", "leaf", "line"],
                )

    schema = f"id {rows.schema['id'].dataType.simpleString()}, digest binary, no int, leaf binary, line {'string' if whole else 'binary'}"
    return rows.mapInArrow(parse, schema)


def candidates(rows: DataFrame, lines: DataFrame, min_docs: int) -> DataFrame:
    """Lines of leaves that at least ``min_docs`` documents reach, with masked tokens and a key per masked line."""
    seen = lines.select("id", "digest", "leaf").distinct().groupBy("leaf").count().where(F.col("count") >= min_docs)
    # Written first, so that its size is known when the join is planned.
    kept = parsed(rows, whole=True).join(stage(seen.select("leaf"), "leaves"), "leaf")
    masks = F.transform(F.split("line", " "), masked)
    kept = kept.select("id", "digest", "no", "leaf", masks.alias("masks")).withColumn("n", F.size("masks"))
    return kept.withColumn("line_key", F.unhex(F.md5(F.array_join("masks", " ").cast("binary"))))


def templates(lines: DataFrame, min_docs: int, max_fields: float) -> DataFrame:
    """Per distinct masked line its template's key; lines that would lose too much to fields are absent."""
    pairs = lines.select("id", "digest", "line_key", "masks", "n", "leaf").distinct()
    distinct = stage(pairs.groupBy("line_key", "masks", "n", "leaf").agg(F.count(F.lit(1)).alias("docs")), "lines")
    placed = distinct.select("line_key", "docs", "n", "leaf", F.posexplode("masks").alias("place", "token"))
    free = placed.where(F.col("token") != FIELD)
    constant = (
        free.groupBy("leaf", "place", "token")
        .agg(F.sum("docs").alias("support"))
        .where((F.col("support") >= min_docs) | (F.col("place") < DEPTH))
    )
    fixed = free.join(constant, ["leaf", "place", "token"]).groupBy("line_key").agg(
        F.sort_array(F.collect_list(F.struct("place", "token"))).alias("constants")
    )
    counted = distinct.join(fixed, "line_key").withColumn("kept", F.size("constants"))
    fields = F.size(F.filter("masks", lambda t: t == FIELD))
    # What is neither constant nor a field by its form has been generalised.
    generalised = F.col("n") - F.col("kept") - fields
    good = counted.where((generalised <= F.col("n") * max_fields) & (2 * F.col("kept") >= F.col("n")))
    # The places of the constants and the number of tokens fix the template.
    name = F.to_json(F.struct("n", "constants"))
    return good.select("line_key", F.unhex(F.md5(name.cast("binary"))).alias("template"))


def repeated(named: DataFrame, by: str, least: int) -> DataFrame:
    """Of lines named by ``by``, those in at least ``least`` documents, but not the ones in the document with the smallest id."""
    recurring = (
        named.select(by, "id", "digest")
        .distinct()
        .groupBy(by)
        .agg(F.count(F.lit(1)).alias("docs"), F.min("id").alias("first"))
        .where((F.col("docs") >= least) & F.col("first").isNotNull())
    )
    gone = named.join(recurring, by).where(F.col("id").isNull() | (F.col("id") > F.col("first")))
    return gone.select("id", "digest", "no")


def dropped_lines(rows: DataFrame, min_docs: int, max_fields: float, min_same: int) -> DataFrame:
    """Per document the numbers of its lines to drop."""
    prints = stage(parsed(rows, whole=False), "line-prints")
    lines = stage(candidates(rows, prints, min_docs), "candidates")
    named = stage(lines.select("id", "digest", "no", "line_key").join(templates(lines, min_docs, max_fields), "line_key"), "named")
    gone = repeated(named, "template", min_docs).unionByName(repeated(prints, "line", min_same))
    return gone.groupBy("id", "digest").agg(F.collect_set("no").alias("gone"))


def drop_templates(
    df: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    min_docs: int = 10,
    max_fields: float = 0.34,
    min_same: int = 2,
    counts: bool = False,
) -> DataFrame:
    """``df`` with recurring lines taken out of ``text``; ``counts`` adds ``n_lines`` and ``n_dropped``."""
    rows = documents(df, key, text)
    gone = dropped_lines(rows, min_docs, max_fields, min_same).alias("g")
    digest, before, after = fresh(df, "digest", "n_lines", "n_dropped")
    body = F.col(f"`{text}`").cast("string")
    marked = df.withColumn(digest, F.unhex(F.md5(body.cast("binary")))).alias("d")
    same = F.col(f"d.`{key}`").eqNullSafe(F.col("g.id")) & F.col(f"d.`{digest}`").eqNullSafe(F.col("g.digest"))
    out = marked.join(gone, same, "left")
    whole = F.col(f"d.`{text}`").cast("string")
    left = F.array_join(F.filter(F.split(whole, "\n"), lambda x, i: ~F.array_contains(F.col("g.gone"), i)), "\n")
    changed = F.when(F.col("g.gone").isNull(), whole).otherwise(left)
    columns = [changed.alias(c) if c == text else F.col(f"d.`{c}`") for c in df.columns]
    if counts:
        columns.append(F.coalesce(F.size(F.split(whole, "\n")), F.lit(0)).cast("long").alias(before))
        columns.append(F.coalesce(F.size("g.gone"), F.lit(0)).cast("long").alias(after))
    return out.select(*columns)


# The same in SQL, on the table ``documents``.
ORACLE = """
WITH docs AS (SELECT DISTINCT doc_id AS id, text FROM documents),
raw AS (SELECT id, text, UNNEST(string_split(text, chr(10))) AS line, UNNEST(range(len(string_split(text, chr(10))))) AS no FROM docs),
words AS (SELECT id, text, no, [t FOR t IN regexp_split_to_array(line, '[ \\t\\n\\x0B\\f\\r]+') IF t <> ''] AS words FROM raw),
lines AS (SELECT *, [CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END FOR t IN words] AS masks FROM words),
leaves AS (SELECT *, len(masks) AS n, masks[1:3] AS lead FROM lines WHERE len(masks) > 0),
seen AS (SELECT n, lead FROM (SELECT DISTINCT n, lead, id, text FROM leaves) GROUP BY n, lead HAVING COUNT(*) >= 10),
cand AS (SELECT leaves.* FROM leaves JOIN seen USING (n, lead)),
distincts AS (SELECT masks, n, lead, COUNT(*) AS docs FROM (SELECT DISTINCT masks, n, lead, id, text FROM cand) GROUP BY ALL),
placed AS (SELECT masks, n, lead, docs, UNNEST(masks) AS token, UNNEST(range(n)) AS place FROM distincts),
constant AS (SELECT n, lead, place, token FROM placed WHERE token <> '<*>' GROUP BY ALL HAVING SUM(docs) >= 10 OR place < 3),
fixed AS (SELECT masks, n, lead, list({'p': place, 't': token} ORDER BY place) AS constants
          FROM placed JOIN constant USING (n, lead, place, token) GROUP BY ALL),
good AS (SELECT masks, n, constants FROM fixed
         WHERE n - len(constants) - len([t FOR t IN masks IF t = '<*>']) <= n * 0.34e0 AND 2 * len(constants) >= n),
named AS (SELECT id, text, no, cand.n, constants FROM cand JOIN good ON good.masks = cand.masks),
recurring AS (SELECT n, constants, MIN(id) AS first FROM (SELECT DISTINCT n, constants, id, text FROM named) GROUP BY n, constants
              HAVING COUNT(*) >= 10 AND MIN(id) IS NOT NULL),
same AS (SELECT words, MIN(id) AS first FROM (SELECT DISTINCT words, id, text FROM words WHERE len(words) > 0) GROUP BY words
         HAVING COUNT(*) >= 2 AND MIN(id) IS NOT NULL),
gone AS (SELECT id, text, no FROM named JOIN recurring USING (n, constants) WHERE id IS NULL OR id > first
         UNION SELECT id, text, no FROM words JOIN same USING (words) WHERE id IS NULL OR id > first),
per AS (SELECT id, text, list(DISTINCT no) AS gone FROM gone GROUP BY id, text)
SELECT doc_id, CASE WHEN gone IS NULL THEN d.text ELSE array_to_string(
         [x[1] FOR x IN list_zip(string_split(d.text, chr(10)), range(len(string_split(d.text, chr(10)))))
          IF NOT list_contains(gone, x[2])], chr(10)) END AS text,
       CAST(COALESCE(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS n_lines, CAST(COALESCE(len(gone), 0) AS BIGINT) AS n_dropped
FROM documents d LEFT JOIN per ON per.id IS NOT DISTINCT FROM d.doc_id AND per.text IS NOT DISTINCT FROM d.text
"""
