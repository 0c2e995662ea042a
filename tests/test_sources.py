import gzip
import functools
import json
import os

import pytest
from pyspark.sql import functions as F, types as T

from siftwork.operators.train import HISTORY_SCHEMA
from siftwork.plans import jobs
from siftwork.sources.delimited import header_of, land, product_schema, read_csv, scan_delimited, valid_class, write_csv
from siftwork.sources.documents import landing_document, read_documents
from siftwork.sources.shared import shared_dir, shared_path, stage
from siftwork.sources.splits import load_split, save_splits
from siftwork.operators.profile import missing_profile
from siftwork.operators.sketches import SKETCH_ERROR, merged_profile, sketched_profile
from siftwork.operators.split import sample_exact
from siftwork.streaming import landing
from siftwork.streaming.landing import land_stream, source


def write_gz(path, lines):
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_ragged_tsv(spark, tmp_path):
    path = str(tmp_path / "raw.csv.gz")
    write_gz(
        path,
        [
            "code\tproduct_name\tfat_100g",
            "1\tfull\t1.5",
            "2\tshort",
            "3\tlong\t1\t2",
            "4\tlong with empty end\t1\t",
            "5\tvery long\t1\t\t\t7",
            '6\t"tab\tinside"\t2',
            '7\t"says ""hi"""\t3',
            "8\tNA\tnot a number",
            "9\t\tNaN",
            '10\t"tab\tinside"\t2\t3',
        ],
    )
    assert header_of(spark, path) == ["code", "product_name", "fat_100g"]
    df = scan_delimited(spark, path, product_schema(header_of(spark, path)), partitions=3)
    got = {r["code"]: (r["product_name"], r["fat_100g"]) for r in df.collect()}
    assert got == {
        "1": ("full", 1.5),
        "2": ("short", None),
        "6": ("tab\tinside", 2.0),
        "7": ('says "hi"', 3.0),
        "8": (None, None),
        "9": (None, None),
    }


def test_class_filter_keeps_spelling(spark):
    df = spark.createDataFrame([("A",), ("a",), ("x",), (None,)], "nutriscore_grade string")
    assert sorted(r[0] for r in land(df).collect()) == ["A", "a"]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "quoted", text', 0.1), (2, None, None)], "a int, b string, `c-d` double")
    write_csv(df, str(tmp_path / "c"))
    assert read_csv(spark, str(tmp_path / "c"), df.schema).exceptAll(df).count() == 0


def test_split_read_opens_one_folder(spark, tmp_path):
    df = spark.range(30).withColumn("split_group", F.element_at(F.array(*map(F.lit, ("train", "val", "test"))), (F.col("id") % 3 + 1).cast("int")))
    folders = save_splits(df, str(tmp_path / "s"))
    assert all(os.path.isdir(p) for p in folders.values())
    val = load_split(spark, str(tmp_path / "s"), "val")
    assert val.count() == 10 and val.columns == ["id"]
    plan = val._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split_group" in plan


def test_landing_document(spark):
    df = spark.createDataFrame([("A",), ("a",), ("e",), ("x",), (None,)], "g string")
    row = landing_document(df, valid_class("g"), "g", ["g"], ["h"], {"data_source": "file"}).collect()[0]
    assert row.asDict() == {
        "total_products": 5, "filtered_products": 3, "columns": 1, "missing_columns": ["h"],
        "grade_distribution": {"A": 2, "E": 1}, "data_source": "file",
    }


def test_landing_document_of_a_sample(spark):
    df = spark.createDataFrame([("A",), ("a",), ("e",), ("x",), (None,)], "g string")
    drawn = spark.createDataFrame([("a",)], "g string")
    row = landing_document(df, valid_class("g"), "g", ["g"], [], sampled=drawn).collect()[0]
    assert (row["total_products"], row["filtered_products"]) == (5, 3)
    assert row["grade_distribution"] == {"A": 1, "E": 0}


def test_shared_folder_follows_the_setting(spark, monkeypatch):
    from types import SimpleNamespace

    def session(setting, master):
        conf = SimpleNamespace(get=lambda key, default=None: setting if key == "spark.checkpoint.dir" else default)
        context = SimpleNamespace(getConf=lambda: conf, master=master, applicationId="app")
        return SimpleNamespace(sparkContext=context, conf=conf)

    assert shared_dir(session("hdfs://x/y/", "yarn")) == "hdfs://x/y"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session(None, "yarn"))
    assert shared_dir(session(None, "local[2]")) == shared_dir(session(None, "local[2]"))


def test_run_documents_of_any_depth(spark, tmp_path):
    for name, extra in (("a", {"training_history": {"val_metrics": {"f1_macro": 0.5}}}), ("b/c", {})):
        os.makedirs(tmp_path / name)
        with open(tmp_path / name / "x_v1_metadata.json", "w") as f:
            json.dump({"model_name": name, **extra}, f, indent=2)
    with open(tmp_path / "a" / "other.json", "w") as f:
        json.dump({"model_name": "no"}, f)
    got = read_documents(spark, str(tmp_path), HISTORY_SCHEMA, multi_line=True).select(
        "model_name", F.col("training_history.val_metrics")["f1_macro"].alias("f"), "training_history.cv_scores.mean"
    )
    assert sorted((r["model_name"], r["f"], r["mean"]) for r in got.collect()) == [("a", 0.5, None), ("b/c", None, None)]


def test_staged_table_is_a_scan(spark):
    df = stage(spark.range(10).groupBy((F.col("id") % 2).alias("k")).count())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Exchange" not in plan


def test_stream_picks_up_new_files_only(spark):
    schema = T.StructType([T.StructField("code", T.LongType()), T.StructField("nutriscore_grade", T.StringType())])
    arriving, out = shared_path(spark, "in"), shared_path(spark, "out")

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(arriving)

    arrive([(1, "a"), (2, "x"), (3, None)])
    rows, counts = land_stream(source(spark, arriving, schema), out, seconds=120)
    assert rows.count() == 1
    arrive([(4, "A"), (5, "e")])
    rows, counts = land_stream(source(spark, arriving, schema), out, seconds=120)
    assert sorted(r["code"] for r in rows.collect()) == [1, 4, 5]
    assert {r["grade"]: r["n"] for r in counts.collect()} == {"A": 2, "E": 1, None: 2}


def test_a_broken_batch_is_landed_once(spark, monkeypatch):
    """The job ends between the rows and the counts of a batch; nothing of it shows until it has been repeated."""
    schema = T.StructType([T.StructField("code", T.LongType()), T.StructField("nutriscore_grade", T.StringType())])
    arriving, out = shared_path(spark, "in"), shared_path(spark, "out")

    def arrive(low, high):
        df = spark.range(low, high).selectExpr("id AS code", "element_at(array('a', 'B', 'x', null), int(id % 4) + 1) AS nutriscore_grade")
        df.coalesce(1).write.mode("append").parquet(arriving)

    def land_all():
        return land_stream(source(spark, arriving, schema), out, seconds=120, key="code", sample=20)

    arrive(0, 100)
    land_all()
    arrive(100, 240)
    with monkeypatch.context() as broken:
        broken.setattr(landing, "COUNTS", "no schema at all")
        with pytest.raises(Exception):
            land_all()
    rows = landing.landed(spark, out, "rows", schema)
    assert rows.count() == 50 and {r["grade"]: r["n"] for r in landing.landed_counts(spark, out).collect()} == {"A": 25, "B": 25, None: 50}
    rows, counts = land_all()
    assert rows.count() == 120 == rows.distinct().count()
    assert {r["grade"]: r["n"] for r in counts.collect()} == {"A": 60, "B": 60, None: 120}
    drawn = landing.landed_sample(spark, out, schema, "code", 20).collect()
    assert {r["code"] for r in drawn} == {r["code"] for r in sample_exact(rows, "code", 20).collect()} and len(drawn) == 20


def test_nothing_has_arrived(spark):
    schema = T.StructType([T.StructField("code", T.LongType()), T.StructField("nutriscore_grade", T.StringType())])
    out = shared_path(spark, "out")
    assert landing.landed(spark, out, "rows", schema).count() == 0 == landing.landed_counts(spark, out).count()


def test_merged_profiles_equal_one_profile(spark):
    df = spark.range(5000).selectExpr("id", "id % 7 AS few", "IF(id % 5 = 0, null, double(id) / 3) AS part", "array(id % 2) AS list", "string(null) AS none")
    parts = [sketched_profile(df.where(f"id % 3 = {k}")) for k in range(3)] + [sketched_profile(df.limit(0))]
    merged = {r["column"]: r for r in merged_profile(functools.reduce(lambda a, b: a.unionByName(b), parts)).collect()}
    for r in missing_profile(df).collect():
        got = merged[r["column"]]
        assert (got["rows"], got["missing_count"], got["missing_percentage"]) == (5000, r["missing_count"], r["missing_percentage"])
        assert abs(got["unique_values"] - r["unique_values"]) <= SKETCH_ERROR * r["unique_values"]
    assert (merged["part"]["least"], merged["part"]["greatest"]) == (1 / 3, 4999 / 3) and merged["none"]["unique_values"] == 0


FOOD = ["a", "b", "c", "d", "e"]


@pytest.fixture(scope="module")
def products(spark):
    """A food-like table: hyphenated names, mixed-case classes, empty columns, bad numbers, country lists."""
    i = F.col("id")
    cell = F.element_at(F.array(*map(F.lit, ["en:france,fr", "USA, Atlantis", "unknown", "Deutschland"])), (i % 4 + 1).cast("int"))
    return spark.range(3000).select(
        i.cast("string").alias("code"),
        F.when(i % 50 == 7, None).when(i % 50 == 8, "unknown").when(i % 2 == 0, F.element_at(F.array(*map(F.lit, FOOD)), (i % 5 + 1).cast("int")))
        .otherwise(F.upper(F.element_at(F.array(*map(F.lit, FOOD)), (i % 5 + 1).cast("int")))).alias("nutriscore_grade"),
        F.when(i % 9 > 0, cell).alias("countries"),
        F.concat(F.lit("g"), (i % 6).cast("string")).alias("pnns_groups_1"),
        F.concat(F.lit("s "), (i % 13).cast("string")).alias("pnns_groups_2"),
        F.when(i % 17 == 0, None).when(i % 97 == 0, 5000.0).otherwise(F.rand(1) * 30 + i % 5).alias("fat_100g"),
        (F.rand(2) * 20).alias("saturated-fat_100g"),
        (F.rand(3) * 60).alias("carbohydrates_100g"),
        F.when(i % 3 > 0, F.rand(4) * 30).alias("sugars_100g"),
        (F.rand(5) * 20).alias("proteins_100g"),
        (F.rand(6) * 3).alias("salt_100g"),
        (F.rand(7) * 900).alias("energy-kcal_100g"),
        (F.rand(8) * 3000).alias("energy_100g"),
        F.when(i % 2 == 0, (i % 4).cast("double")).alias("additives_n"),
        F.when(i % 100 == 0, 1.0).alias("fruits-vegetables-nuts_100g"),
    ).cache()


def test_jobs_from_raw_file_to_report(spark, products, tmp_path):
    raw = str(tmp_path / "raw")
    products.coalesce(2).write.option("header", True).option("sep", "\t").option("compression", "gzip").csv(raw)
    landed = jobs.landing_job(spark, raw, str(tmp_path / "landed"), partitions=4)
    assert landed.count() == products.where("lower(nutriscore_grade) in ('a','b','c','d','e')").count()
    before = sorted(os.listdir(tmp_path / "landed"))
    jobs.landing_job(spark, raw, str(tmp_path / "landed"), sample=5)
    assert sorted(os.listdir(tmp_path / "landed")) == before

    jobs.prepare_job(spark, str(tmp_path / "landed"), str(tmp_path / "out"), scaling_method="standard", top_n_labels=3)
    train = load_split(spark, str(tmp_path / "out/splits"), "train")
    assert {c for c in train.columns if not c.startswith("PC")} == {"code", "nutriscore_grade"}
    assert {r[0] for r in train.select("nutriscore_grade").distinct().collect()} == set(FOOD)
    with open(next((tmp_path / "out/split_metadata").glob("*.json"))) as f:
        report = json.load(f)
    assert report["statistics"]["is_balanced"] and set(report["statistics"]["train_size"]) == set(FOOD)

    trained = jobs.train_job(spark, str(tmp_path / "out/splits"), str(tmp_path / "model"), "logistic_regression", folds=2, max_iter=20)
    assert all(c.startswith("PC") for c in trained.fitted.stages[0].values["columns"])
    metrics, per_class, matrix = jobs.evaluate_job(spark, str(tmp_path / "out/splits"), str(tmp_path / "model"))
    assert 0 <= metrics["accuracy"] <= 1 and per_class.count() == 8 and matrix.count() == 5
    runs = read_documents(spark, str(tmp_path / "model"), HISTORY_SCHEMA)
    assert runs.select("model_name").collect()[0][0] == "LogisticRegression"

    jobs.prepare_job(spark, str(tmp_path / "landed"), str(tmp_path / "eda"), eda_only=True, include_pca=False, include_scaling=False)
    eda = spark.read.parquet(str(tmp_path / "eda/eda"))
    assert {"countries_France", "pnns_groups_1_g0", "high_fat", "fat_to_protein_ratio"} <= set(eda.columns)
    assert eda.agg(F.max("fat_100g")).collect()[0][0] <= 100


def test_cleaning_job(spark, products, tmp_path):
    products.where("nutriscore_grade is not null").write.parquet(str(tmp_path / "in"))
    jobs.clean_job(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "report"))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert "energy_100g" not in out.columns and "fruits-vegetables-nuts_100g" not in out.columns
    assert {r[0] for r in out.select("countries").distinct().collect()} == {"France", "United States", "unknown", "Germany"}
    (tmp_path / "codes.csv").write_text("two,three,name\nat,atl,Atlantis\n")
    jobs.main(["clean", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out2"), "--countries", str(tmp_path / "codes.csv")])
    named = spark.read.parquet(str(tmp_path / "out2")).select("countries").distinct().collect()
    assert {r[0] for r in named} == {"France", "Atlantis,United States", "unknown", "Germany"}
    with open(next((tmp_path / "report").glob("*.json"))) as f:
        report = json.load(f)
    assert report["dropped_features"] == ["fruits-vegetables-nuts_100g"]
    assert report["imputation_statistics"]["additives_n"]["rationale"] == "Assume no additives"


def test_fit_sees_train_rows_only(spark, products, tmp_path):
    from pyspark.ml import PipelineModel

    from siftwork.plans.prepare import fit_preparation, preparation

    table = products.where("nutriscore_grade is not null").withColumn("nutriscore_grade", F.lower("nutriscore_grade"))
    marked = table.withColumn("split_group", F.when(F.col("code").cast("int") < 2000, "train").otherwise("test"))
    flow = preparation(include_pca=False, scaling_method="minmax")
    model = fit_preparation(flow, marked)
    alone = flow.fit(marked.where("split_group = 'train'"))
    assert model.transform(marked).exceptAll(alone.transform(marked)).count() == 0
    model.write().overwrite().save(str(tmp_path / "flow"))
    again = PipelineModel.load(str(tmp_path / "flow"))
    assert again.transform(marked).exceptAll(model.transform(marked)).count() == 0
    full = preparation().fit(marked)
    full.write().overwrite().save(str(tmp_path / "full"))
    assert PipelineModel.load(str(tmp_path / "full")).transform(marked).columns == full.transform(marked).columns


def test_a_broken_landing_is_replaced(spark, tmp_path):
    from siftwork.sources.delimited import land_once, landed_before

    path = str(tmp_path / "landed")
    (tmp_path / "landed" / "_temporary").mkdir(parents=True)
    assert not landed_before(spark, path)
    land_once(spark.range(3), path)
    assert landed_before(spark, path)
    land_once(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3
