"""Queries over sample tables: cleaning, encoding, folds, splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark.catalog.fixtures import SAMPLES, TEST_SAMPLES, fixture, load, with_tables
from foldmark.catalog.registry import query
from foldmark.functions.encode import SITE_CODES, encode_features
from foldmark.operators import prepare, splits
from foldmark.operators.contracts import duplicate_ids, keep_preferred
from foldmark.schemas import ID, SITE, SampleSet

_SITE_CASE = " ".join(f"WHEN '{s}' THEN {c}" for s, c in SITE_CODES.items())
_SITE_LIST = ", ".join(f"'{s}'" for s in SITE_CODES)
_ENCODED = f"""
       CASE sex WHEN 'male' THEN 1.0 WHEN 'female' THEN 0.0 ELSE 0.5 END::DOUBLE AS sex,
       coalesce(age_approx / 100, 0)::DOUBLE AS age_approx,
       CASE {SITE} {_SITE_CASE} ELSE 0 END::DOUBLE AS {SITE}"""

_FOLDED = """
SELECT *, ((row_number() OVER (ORDER BY target, md5(image_name || ':47'), image_name) - 1) % 8)::INTEGER AS fold
FROM samples
"""


def samples(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, SAMPLES)


def folded(spark: SparkSession, sf: str) -> DataFrame:
    return splits.stratified_folds(samples(spark, sf))


def _sql(body: str) -> str:
    return with_tables(body, samples=SAMPLES)


def _folded_sql(body: str) -> str:
    return with_tables(body, samples=SAMPLES, folded=_FOLDED)


@query("encode_features", _sql(f"SELECT image_name, coalesce(patient_id, '0') AS patient_id,{_ENCODED} FROM samples"))
def encode(spark, sf):
    return encode_features(samples(spark, sf)).select(ID, "patient_id", "sex", "age_approx", SITE)


@query("encode_test", with_tables(f"SELECT image_name,{_ENCODED} FROM tests", tests=TEST_SAMPLES))
def encode_test(spark, sf):
    return encode_features(fixture(spark, sf, TEST_SAMPLES)).select(ID, "sex", "age_approx", SITE)


@query(
    "one_hot_sites",
    _sql(
        "SELECT image_name, "
        + ", ".join(f"coalesce(({SITE} = '{s}')::INTEGER, 0) AS \"site_{s}\"" for s in SITE_CODES)
        + f", CASE WHEN {SITE} IN ({_SITE_LIST}) THEN 0 ELSE 1 END AS site_nan FROM samples"
    ),
)
def one_hot(spark, sf):
    encoded = encode_features(samples(spark, sf))
    return encoded.select(ID, *[F.col(f"`site_{s}`") for s in SITE_CODES], "site_nan")


def raw_tables(df: DataFrame) -> dict[str, DataFrame]:
    """Three raw tables with different columns, one per dataset."""

    def part(name: str) -> DataFrame:
        return df.where(F.col("dataset") == name).drop("dataset")

    return {
        "main": part("main").withColumn("diagnosis", F.lit("unknown")).withColumn("benign_malignant", F.lit("benign")),
        "older": part("older")
        .drop("patient_id")
        .withColumns({"tfrecord": F.lit(1), "width": F.lit(8), "height": F.lit(8)}),
        "extra": part("extra").drop("age_approx"),
    }


@query(
    "prepare_union",
    _sql(
        f"""
        SELECT * REPLACE (CASE WHEN {SITE} IN ('posterior torso', 'lateral torso', 'anterior torso')
                               THEN 'torso' ELSE {SITE} END AS {SITE})
        FROM (SELECT * FROM samples WHERE dataset = 'main'
              UNION ALL BY NAME SELECT * EXCLUDE (patient_id) FROM samples WHERE dataset = 'older'
              UNION ALL BY NAME SELECT * EXCLUDE (age_approx) FROM samples WHERE dataset = 'extra')
        """
    ),
)
def prepare_union(spark, sf):
    merged = prepare.union_sources(raw_tables(samples(spark, sf)))
    return prepare.canonical_sites(prepare.drop_columns(merged))


@query(
    "deny_list",
    _sql(
        """
        SELECT image_name, target FROM samples
        WHERE image_name NOT IN (SELECT 'IMG_' || lpad(CAST(page_id AS VARCHAR), 12, '0') FROM pages)
        """
    ),
)
def deny_list(spark, sf):
    pages = load(spark, sf, "pages")
    denied = pages.select(F.concat(F.lit("IMG_"), F.lpad(F.col("page_id").cast("string"), 12, "0")).alias(ID))
    return prepare.drop_denied(samples(spark, sf), denied).select(ID, "target")


@query(
    "duplicate_ids",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def duplicates(spark, sf):
    return duplicate_ids(load(spark, sf, "lineitem"), ("l_orderkey", "l_linenumber"))


@query(
    "drop_duplicates_by_priority",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice, l_partkey FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY l_extendedprice DESC, l_partkey, l_suppkey) AS place
      FROM lineitem) WHERE place = 1
    """,
)
def preferred(spark, sf):
    rows = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey"
    )
    order = (F.col("l_extendedprice").desc(), F.col("l_partkey"), F.col("l_suppkey"))
    return keep_preferred(rows, ("l_orderkey", "l_linenumber"), order).drop("l_suppkey")


@query("stratified_folds", _folded_sql("SELECT image_name, target, fold FROM folded"))
def stratified(spark, sf):
    return folded(spark, sf).select(ID, "target", "fold")


@query(
    "stratified_folds_orders",
    """
    SELECT o_orderkey, o_orderstatus,
           ((row_number() OVER (ORDER BY o_orderstatus, md5(o_orderkey || ':47'), o_orderkey) - 1) % 8)::INTEGER AS fold
    FROM orders
    """,
)
def stratified_orders(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return splits.stratified_folds(orders, "o_orderstatus", "o_orderkey")


@query("fold_summary", _folded_sql("SELECT fold, target, count(*) AS n FROM folded GROUP BY ALL"))
def summary(spark, sf):
    return splits.fold_summary(folded(spark, sf))


_SANITY = """
SELECT image_name, fold, target,
       CASE WHEN row_number() OVER (PARTITION BY fold, target ORDER BY image_name, dataset) <= 2
            THEN 1 ELSE 0 END AS sanity_check
FROM folded
"""


@query("sanity_flags", _folded_sql(_SANITY))
def sanity_flags(spark, sf):
    return prepare.flag_sanity_rows(folded(spark, sf)).select(ID, "fold", "target", "sanity_check")


@query("sanity_subset", _folded_sql(f"SELECT image_name, fold, target FROM ({_SANITY}) WHERE sanity_check = 1"))
def sanity_subset(spark, sf):
    return prepare.sanity_rows(prepare.flag_sanity_rows(folded(spark, sf))).select(ID, "fold", "target")


@query(
    "kfold_val_index",
    _folded_sql("SELECT image_name, fold, fold // 2 AS val_index_4, fold AS val_index_8 FROM folded"),
)
def val_index(spark, sf):
    four = splits.with_val_index(folded(spark, sf), 4).withColumnRenamed("val_index", "val_index_4")
    eight = splits.with_val_index(four, 8).withColumnRenamed("val_index", "val_index_8")
    return eight.select(ID, "fold", "val_index_4", "val_index_8")


@query(
    "split_by_folds",
    _folded_sql(
        "SELECT image_name, CASE WHEN fold IN (0, 1) THEN 'validation' ELSE 'train' END AS part FROM folded"
    ),
)
def split_by_folds(spark, sf):
    train, validation = splits.train_validate_split(SampleSet(folded(spark, sf)))
    return train.df.select(ID, F.lit("train").alias("part")).unionByName(
        validation.df.select(ID, F.lit("validation").alias("part"))
    )


@query(
    "pick_split",
    _folded_sql("SELECT image_name, CASE WHEN fold IN (4, 5) THEN 'validation' ELSE 'train' END AS part FROM folded"),
)
def pick_split(spark, sf):
    train, validation = splits.pick_split(SampleSet(folded(spark, sf)), 2, 4)
    return train.df.select(ID, F.lit("train").alias("part")).unionByName(
        validation.df.select(ID, F.lit("validation").alias("part"))
    )


@query("split_dataset", _folded_sql("SELECT image_name, fold, target FROM folded WHERE dataset = 'older'"))
def split_dataset(spark, sf):
    return prepare.only_dataset(folded(spark, sf), "older").select(ID, "fold", "target")


@query("dataset_counts", _sql("SELECT dataset, count(*) AS n, count(target) AS n_labelled FROM samples GROUP BY 1"))
def dataset_counts(spark, sf):
    return samples(spark, sf).groupBy("dataset").agg(F.count("*").alias("n"), F.count("target").alias("n_labelled"))


@query(
    "split_80_20",
    _sql(
        """
        SELECT image_name, (row_number() OVER (ORDER BY md5(image_name || ':42'), image_name)
                            <= ceil(round(count(*) OVER () * 0.2, 9)))::INTEGER AS is_test
        FROM samples
        """
    ),
)
def split_80_20(spark, sf):
    return splits.holdout_split(samples(spark, sf)).select(ID, F.col("is_test").cast("int").alias("is_test"))


@query("head_n", _sql("SELECT image_name, target FROM samples ORDER BY image_name LIMIT 4096"))
def head_n(spark, sf):
    return splits.head_rows(samples(spark, sf).select(ID, "target"), 4096)


@query(
    "prepared_table",
    with_tables(
        f"""
        SELECT image_name, sex, {SITE}, target, dataset, fold,
               CASE WHEN row_number() OVER (PARTITION BY fold, target ORDER BY image_name, dataset) <= 2
                    THEN 1 ELSE 0 END AS sanity_check
        FROM (SELECT * REPLACE (CASE WHEN {SITE} LIKE '% torso' THEN 'torso' ELSE {SITE} END AS {SITE}),
                     ((row_number() OVER (ORDER BY target, md5(image_name || ':47'), image_name) - 1) % 8)::INTEGER
                     AS fold
              FROM samples
              WHERE image_name NOT IN (SELECT 'IMG_' || lpad(CAST(page_id AS VARCHAR), 12, '0') FROM pages))
        """,
        samples=SAMPLES,
    ),
)
def prepared_table(spark, sf):
    pages = load(spark, sf, "pages")
    denied = pages.select(F.concat(F.lit("IMG_"), F.lpad(F.col("page_id").cast("string"), 12, "0")).alias(ID))
    table = prepare.prepare_training_table(raw_tables(samples(spark, sf)), denied)
    return table.select(ID, "sex", SITE, "target", "dataset", "fold", "sanity_check")
