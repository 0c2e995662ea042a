"""Scans, sinks and report documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwork.catalog.base import (
    FEATURES_SQL,
    GRADED_SQL,
    RAW_SQL,
    features,
    graded,
    query,
    r6,
    r6_sql,
    raw_products,
    rounded,
    split_sql,
    table,
)
from siftwork.functions.presets import CLASSES
from siftwork.operators.missing import MissingValueHandler, report_row
from siftwork.operators.profile import missing_profile, reconcile_columns
from siftwork.operators.scale import FeatureScaler, FeatureScalerModel
from siftwork.operators.split import assign_split, split_metadata
from siftwork.sources.delimited import land_once, read_csv, scan_delimited, valid_class, write_csv
from siftwork.sources.documents import landing_document, write_document
from siftwork.sources.shared import shared_path, stage
from siftwork.sources.splits import load_split, save_splits
from siftwork.streaming.landing import class_totals

WANTED = ["code", "grade", "qty", "avg_price", "fibre", "n_name", "brands"]


@query(
    "a1_tsv_scan",
    """SELECT o_orderkey AS code, o_orderpriority AS label,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price
       FROM orders WHERE o_orderstatus <> 'F'""",
)
def tsv_scan(spark, sf_dir):
    """Compressed TSV with ragged rows: finished orders get a field too many, pending ones lack the last."""
    status = F.col("o_orderstatus")
    fields = [F.col("o_orderkey").cast("string"), F.col("o_orderpriority")]
    price = F.when(status == "P", None).otherwise(F.col("o_totalprice").cast("string"))
    junk = F.when(status == "F", F.lit(""))
    line = F.concat_ws("\t", *fields, price, junk)
    path = shared_path(spark, "tsv")
    table(spark, sf_dir, "orders").select(line.alias("value")).write.option("compression", "gzip").text(path)
    schema = spark.createDataFrame([], "code bigint, label string, price double").schema
    return scan_delimited(spark, path, schema, header=False)


@query(
    "a2_landing_counts",
    f"""WITH {RAW_SQL} SELECT CASE WHEN LOWER(grade) IN ('a','b','c','d','e') THEN UPPER(grade) END AS grade,
         COUNT(*) AS n FROM raw GROUP BY 1""",
)
def landing_counts(spark, sf_dir):
    return class_totals(raw_products(spark, sf_dir), "grade", CLASSES)


@query("a3_csv_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_scan(spark, sf_dir):
    df = table(spark, sf_dir, "customer")
    path = shared_path(spark, "csv")
    write_csv(df, path)
    return read_csv(spark, path, df.schema)


@query(
    "a4_load_split",
    f"""WITH {GRADED_SQL}, {split_sql('graded', 'code', 'grade')}
       SELECT code, qty, avg_price, grade FROM divided WHERE split_group = 'val'""",
)
def load_one_split(spark, sf_dir):
    df = assign_split(stage(graded(spark, sf_dir).select("code", "qty", "avg_price", "grade")), "grade", "code")
    path = shared_path(spark, "splits")
    save_splits(df, path)
    return load_split(spark, path, "val")


@query("a5_csv_sink", f"WITH {FEATURES_SQL} SELECT * FROM features")
def csv_sink(spark, sf_dir):
    df = features(spark, sf_dir)
    path = shared_path(spark, "sink")
    write_csv(df, path)
    return read_csv(spark, path, df.schema)


@query(
    "a6_split_sink",
    f"""WITH {GRADED_SQL}, {split_sql('graded', 'code', 'grade')}
       SELECT split_group AS split, COUNT(*) AS n, MIN(code) AS first_code, MAX(code) AS last_code
       FROM divided GROUP BY 1""",
)
def split_sink(spark, sf_dir):
    df = assign_split(stage(graded(spark, sf_dir).select("code", "qty", "grade")), "grade", "code")
    folders = save_splits(df, shared_path(spark, "splits"))
    parts = [spark.read.parquet(p).withColumn("split", F.lit(s)) for s, p in folders.items()]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return whole.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.min("code").alias("first_code"), F.max("code").alias("last_code")
    )


@query(
    "a7_landing_document",
    f"""WITH {RAW_SQL} SELECT COUNT(*) AS total_products,
         COUNT(*) FILTER (WHERE LOWER(grade) IN ('a','b','c','d','e')) AS filtered_products,
         CAST(5 AS BIGINT) AS columns, 'fibre,brands' AS missing_columns,
         {", ".join(f"COUNT(*) FILTER (WHERE UPPER(grade) = '{c.upper()}') AS n_{c}" for c in CLASSES)}
       FROM raw""",
)
def landing_report(spark, sf_dir):
    df = raw_products(spark, sf_dir)
    existing = [c for c in WANTED if c in df.columns]
    missing = [c for c in WANTED if c not in df.columns]
    path = shared_path(spark, "landing_metadata")
    write_document(landing_document(df, valid_class("grade"), "grade", existing, missing), path)
    schema = (
        "total_products bigint, filtered_products bigint, columns bigint, missing_columns array<string>, "
        "grade_distribution map<string,bigint>"
    )
    back = spark.read.schema(schema).json(path)
    return back.select(
        "total_products",
        "filtered_products",
        "columns",
        F.array_join("missing_columns", ",").alias("missing_columns"),
        *[F.coalesce(F.col("grade_distribution")[c.upper()], F.lit(0)).alias(f"n_{c}") for c in CLASSES],
    )


@query(
    "a8_split_document",
    f"""WITH {GRADED_SQL}, {split_sql('graded', 'code', 'grade')},
       n AS (SELECT split_group, grade, COUNT(*) AS size FROM divided GROUP BY 1, 2)
       SELECT split_group AS split, grade AS class, size,
         {r6_sql("size / SUM(size) OVER (PARTITION BY split_group)")} AS share, TRUE AS is_balanced FROM n""",
)
def split_document(spark, sf_dir):
    df = assign_split(stage(graded(spark, sf_dir).select("code", "grade")), "grade", "code")
    path = shared_path(spark, "split_metadata")
    write_document(split_metadata(df, "grade", {}), path)
    maps = ", ".join(f"{s}_size: map<string,bigint>, {s}_distribution: map<string,double>" for s in ("train", "val", "test"))
    back = spark.read.schema(f"statistics struct<{maps}, max_deviation: double, is_balanced: boolean>").json(path)
    parts = [
        back.select(
            F.lit(s).alias("split"),
            F.explode(f"statistics.{s}_size").alias("class", "size"),
            F.col(f"statistics.{s}_distribution").alias("d"),
            "statistics.is_balanced",
        ).select("split", "class", "size", r6(F.try_element_at("d", F.col("class"))).alias("share"), "is_balanced")
        for s in ("train", "val", "test")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "a9_imputation_document",
    f"""WITH {FEATURES_SQL}
       SELECT 'avg_price' AS column, 'median' AS method, {r6_sql("MEDIAN(avg_price)")} AS value,
         COUNT(*) - COUNT(avg_price) AS missing_count, COUNT(*) - COUNT(avg_price) AS profiled FROM features
       UNION ALL SELECT 'max_tax', 'constant', 0e0, COUNT(*) - COUNT(max_tax), COUNT(*) - COUNT(max_tax) FROM features
       UNION ALL SELECT 'types', 'constant', NULL, COUNT(*) - COUNT(types), COUNT(*) - COUNT(types) FROM features""",
)
def imputation_document(spark, sf_dir):
    df = stage(features(spark, sf_dir).select("code", "avg_price", "max_tax", "types", "o_orderpriority"))
    model = MissingValueHandler("o_orderpriority", 0.95, {"max_tax": 0}).fit(df)
    path = shared_path(spark, "imputation_report")
    write_document(report_row(model, missing_profile(df), 0.95), path)
    back = spark.read.schema(
        "imputation_statistics map<string,struct<method: string, value: string, missing_count: bigint>>, "
        "missing_value_analysis map<string,struct<missing_count: bigint>>"
    ).json(path)
    rows = back.select(F.explode("imputation_statistics").alias("column", "s"), "missing_value_analysis")
    return rows.select(
        "column",
        "s.method",
        r6(F.col("s.value").try_cast("double")).alias("value"),
        "s.missing_count",
        F.try_element_at("missing_value_analysis", F.col("column"))["missing_count"].alias("profiled"),
    )


@query(
    "a13_saved_scaler",
    f"""WITH {FEATURES_SQL}, s AS (SELECT AVG(c_acctbal) AS m1, STDDEV_POP(c_acctbal) AS s1,
         AVG(o_totalprice) AS m2, STDDEV_POP(o_totalprice) AS s2 FROM features)
       SELECT code, {r6_sql("(c_acctbal - m1) / s1")} AS c_acctbal, {r6_sql("(o_totalprice - m2) / s2")} AS o_totalprice
       FROM features, s""",
)
def saved_scaler(spark, sf_dir):
    df = features(spark, sf_dir).select("code", "c_acctbal", "o_totalprice")
    path = shared_path(spark, "scaler")
    FeatureScaler("standard").fit(df).write().overwrite().save(path)
    return rounded(FeatureScalerModel.load(path).transform(df), "c_acctbal", "o_totalprice")


@query("a15_land_once", "SELECT o_orderkey, o_orderstatus FROM orders")
def landed_once(spark, sf_dir):
    """The second write finds the output and leaves it alone."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    path = shared_path(spark, "landed")
    land_once(orders, path)
    land_once(orders.withColumn("o_orderstatus", F.lit("?")), path)
    return spark.read.parquet(path)


ABSENT = ("fibre", "brands")
RECONCILED = [
    f"SELECT '{c}' AS column, FALSE AS present, CAST(0 AS BIGINT) AS non_null"
    if c in ABSENT
    else f"SELECT '{c}' AS column, TRUE AS present, COUNT({c}) AS non_null FROM raw"
    for c in WANTED
]


@query("a16_column_reconciliation", f"WITH {RAW_SQL} {' UNION ALL '.join(RECONCILED)}")
def column_reconciliation(spark, sf_dir):
    return reconcile_columns(raw_products(spark, sf_dir), WANTED)
