"""The toolkit's tables, read out of the driver's tables.

Each definition is one SELECT whose text runs in Spark SQL and in DuckDB alike;
``{table}`` stands for an input table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SAMPLES = """
SELECT 'IMG_' || lpad(CAST(d.doc_id AS STRING), 12, '0') AS image_name,
       CASE WHEN d.doc_id % 7 = 0 THEN NULL ELSE 'P' || CAST(d.doc_id % 97 AS STRING) END AS patient_id,
       CASE d.lang WHEN 'en' THEN 'male' WHEN 'fr' THEN 'female' WHEN 'de' THEN 'unknown' END AS sex,
       CASE WHEN d.n_chars % 11 = 0 THEN NULL ELSE CAST(5 * (d.n_chars % 19) AS DOUBLE) END AS age_approx,
       CASE d.doc_id % 11 WHEN 0 THEN 'head/neck' WHEN 1 THEN 'upper extremity' WHEN 2 THEN 'lower extremity'
            WHEN 3 THEN 'torso' WHEN 4 THEN 'palms/soles' WHEN 5 THEN 'oral/genital'
            WHEN 6 THEN 'posterior torso' WHEN 7 THEN 'lateral torso' WHEN 8 THEN 'anterior torso'
            WHEN 9 THEN 'elbow' END AS anatom_site_general_challenge,
       CASE d.doc_id % 3 WHEN 0 THEN 'main' WHEN 1 THEN 'older' ELSE 'extra' END AS dataset,
       l.toxic AS target
FROM {documents} d JOIN {labels} l ON l.doc_id = d.doc_id
"""

# Documents without a label play the unlabelled test table.
TEST_SAMPLES = """
SELECT 'IMG_' || lpad(CAST(d.doc_id AS STRING), 12, '0') AS image_name,
       CASE d.lang WHEN 'en' THEN 'male' WHEN 'fr' THEN 'female' WHEN 'de' THEN 'unknown' END AS sex,
       CASE WHEN d.n_chars % 11 = 0 THEN NULL ELSE CAST(5 * (d.n_chars % 19) AS DOUBLE) END AS age_approx,
       CASE d.doc_id % 11 WHEN 0 THEN 'head/neck' WHEN 1 THEN 'upper extremity' WHEN 2 THEN 'lower extremity'
            WHEN 3 THEN 'torso' WHEN 4 THEN 'palms/soles' WHEN 5 THEN 'oral/genital'
            WHEN 9 THEN 'elbow' END AS anatom_site_general_challenge
FROM {documents} d LEFT ANTI JOIN {labels} l ON l.doc_id = d.doc_id
"""

TRUTH = """
SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS target FROM {orders}
"""

PREDS = """
SELECT l_orderkey AS id, max(l_discount) * 10 AS m0, max(l_tax) * 12.5 AS m1, max(l_quantity) / 50 AS m2
FROM {lineitem} GROUP BY l_orderkey
"""

LINE_SCORES = """
SELECT l_orderkey AS id, l_discount, l_extendedprice, l_shipdate,
       l_linestatus, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS target
FROM {lineitem}
"""

# Divided by a number with factors other than 2 and 5, so that no mean falls on a rounding border.
TTA = """
SELECT user_id AS id, event_type AS fold, value / 567 AS p, event_id FROM {events}
"""

METRIC_LOG = """
SELECT user_id AS run, value AS val_auc, event_id FROM {events}
"""

VECTORS = """
SELECT vec_id, embedding, label FROM {embeddings}
"""

# One file per (run, event type): fold models, a text file and one misnamed model.
MODEL_FILES = """
SELECT run, file FROM (
  SELECT user_id AS run,
         CASE event_type WHEN 'error' THEN 'notes.txt' WHEN 'signup' THEN 'best_fold_0_4.ckpt'
              WHEN 'view' THEN 'fold_0_4_epoch=3.ckpt' WHEN 'click' THEN 'fold_1_4_epoch=5.ckpt'
              ELSE 'fold_2_4.ckpt' END AS file
  FROM {events}) named
GROUP BY run, file
"""

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

_NAME = re.compile(r"\{(\w+)\}")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fixture(spark: SparkSession, sf_dir: str, definition: str) -> DataFrame:
    names = set(_NAME.findall(definition))
    return spark.sql(definition, **{n: load(spark, sf_dir, n) for n in names})


def sql_text(definition: str) -> str:
    """The definition over DuckDB's registered views."""
    text = definition.replace("LEFT ANTI JOIN", "ANTI JOIN")
    return _NAME.sub(r"\1", text).strip()


def with_tables(query: str, **definitions: str) -> str:
    """A query behind one common table expression per fixture."""
    ctes = ",\n".join(f"{name} AS (\n{sql_text(text)}\n)" for name, text in definitions.items())
    return f"WITH {ctes}\n{query.strip()}"
