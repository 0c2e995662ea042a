"""Incremental landing and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwork.catalog.base import RANGES, RAW_SQL, features, query, r6_sql, raw_products, rounded, table
from siftwork.catalog.filters import FLOW_COLUMNS, FLOW_RULES, FLOW_SQL
from siftwork.catalog.models import EMB_SQL, ODD_KEY, knn_ctes, parts, vectors
from siftwork.functions.presets import CLASSES, RELEVANT_COLUMNS
from siftwork.operators.neighbours import KNNClassifier
from siftwork.operators.profile import missing_profile
from siftwork.operators.sketches import SKETCH_ERROR
from siftwork.plans.prepare import fit_preparation, preparation
from siftwork.sources.shared import shared_path
from siftwork.streaming.landing import land_stream, landed_sample, profile_stream, source
from siftwork.streaming.scoring import score_stream


def _arriving(df, name: str, key: str = "code"):
    """The table as a folder of several files, read as a stream of a few files per batch."""
    path = shared_path(df.sparkSession, name)
    df.repartition(6, key).write.parquet(path)
    return source(df.sparkSession, path, df.schema, maxFilesPerTrigger=2)


def _landed(spark, sf_dir):
    df = raw_products(spark, sf_dir).withColumnRenamed("grade", "nutriscore_grade")
    wanted = [c for c in df.columns if c in RELEVANT_COLUMNS]
    return land_stream(_arriving(df.select(*wanted), "arriving"), shared_path(spark, "landing"), classes=CLASSES)


@query(
    "st1_landed_rows",
    f"WITH {RAW_SQL} SELECT grade AS nutriscore_grade, CAST(code AS BIGINT) AS code FROM raw WHERE LOWER(grade) IN ('a','b','c','d','e')",
)
def landed_rows(spark, sf_dir):
    return _landed(spark, sf_dir)[0]


@query(
    "st1_landing_counters",
    f"""WITH {RAW_SQL} SELECT CASE WHEN LOWER(grade) IN ('a','b','c','d','e') THEN UPPER(grade) END AS grade, COUNT(*) AS n
       FROM raw GROUP BY 1""",
)
def landing_counters(spark, sf_dir):
    """Counters kept over the batches equal those of one pass over everything."""
    return _landed(spark, sf_dir)[1]


@query(
    "j1_sample_landed",
    f"""WITH {RAW_SQL} SELECT grade AS nutriscore_grade, CAST(code AS BIGINT) AS code FROM raw
       WHERE LOWER(grade) IN ('a','b','c','d','e') ORDER BY md5('42:' || CAST(code AS VARCHAR)) LIMIT 1000""",
)
def sample_landed(spark, sf_dir):
    """An exact sample kept while rows arrive: no landed row is read again."""
    df = raw_products(spark, sf_dir).withColumnRenamed("grade", "nutriscore_grade")
    wanted = [c for c in df.columns if c in RELEVANT_COLUMNS]
    out = shared_path(spark, "landing")
    rows, _ = land_stream(_arriving(df.select(*wanted), "arriving"), out, classes=CLASSES, key="code", sample=1000)
    return landed_sample(spark, out, rows.schema, "code", 1000)


PROFILED = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}


@query(
    "c1_profile_of_batches",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column, COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS missing_count,
       ROUND((COUNT(*) - COUNT({c})) * 1e2 / COUNT(*), 2) AS missing_percentage, {least} AS least, {greatest} AS greatest,
       COUNT(DISTINCT {c}) AS unique_values, TRUE AS within_bound
       FROM (SELECT * REPLACE (CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal) FROM customer)"""
        for c, kind in PROFILED.items()
        for least, greatest in [
            ("NULL", "NULL") if kind == "string" else (f"CAST(MIN({c}) AS DOUBLE)", f"CAST(MAX({c}) AS DOUBLE)")
        ]
    ),
)
def profile_of_batches(spark, sf_dir):
    """A profile merged from sketches of arriving batches, beside exact distinct counts of the whole table."""
    df = table(spark, sf_dir, "customer").select(*PROFILED).withColumn("c_acctbal", F.expr("CASE WHEN c_acctbal >= 0 THEN c_acctbal END"))
    merged = profile_stream(_arriving(df, "profiled", "c_custkey"), shared_path(spark, "profiles"))
    exact = missing_profile(df).select("column", F.col("unique_values").alias("exact"))
    close = F.abs(F.col("unique_values") - F.col("exact")) <= F.col("exact") * SKETCH_ERROR
    return merged.join(exact, "column").select(
        "column", "rows", "missing_count", "missing_percentage", "least", "greatest", F.col("exact").alias("unique_values"), close.alias("within_bound")
    )


@query(
    "st2_stream_scoring",
    f"""WITH {FLOW_SQL} SELECT code, o_orderpriority,
       {", ".join(f"{r6_sql(f'({c} - m_{c}) / s_{c}')} AS {c}" for c in FLOW_COLUMNS)} FROM derived, moments""",
)
def stream_scoring(spark, sf_dir):
    """A flow fitted on the table, applied to the same rows arriving as a stream."""
    df = features(spark, sf_dir).select("code", "avg_price", "avg_disc", "c_acctbal", "o_totalprice", "o_orderpriority")
    stream = _arriving(df, "scoring")
    flow = preparation(
        target="o_orderpriority",
        scaling_method="standard",
        include_encoding=False,
        include_pca=False,
        ranges=RANGES,
        rules=FLOW_RULES,
        metadata=["code", "o_orderpriority"],
        log_columns=[],
    )
    scored = score_stream(stream, fit_preparation(flow, df), shared_path(spark, "scored"))
    return rounded(scored, *FLOW_COLUMNS)


@query(
    "st2_stream_neighbours",
    f"WITH {EMB_SQL}, {knn_ctes('te', 'tr')} SELECT vec_id AS row, CAST(prediction AS DOUBLE) AS prediction FROM pred",
)
def stream_neighbours(spark, sf_dir):
    """Vectors that arrive as a stream, with repeated and missing keys, scored by a join over cells."""
    train, test = parts(vectors(spark, sf_dir), "train", "test")
    arriving = test.select(F.col("vec_id").alias("row"), "embedding").withColumn("vec_id", F.expr(ODD_KEY.replace("vec_id", "row")))
    model = KNNClassifier("embedding", "label", "vec_id", broadcast_bytes=0, block_rows=2000).fit(train)
    return score_stream(_arriving(arriving, "vectors", "row"), model, shared_path(spark, "scored")).select("row", "prediction")
