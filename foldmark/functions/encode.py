"""Row-local encodings of the demographic and site columns.

The vocabulary is fixed, so a row encodes the same way alone, in a train/test
union, or in a stream: no fit step and no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldmark.schemas import ID, SITE

# Site codes, sex values and feature lists of the prepared feature table.
SITE_CODES = {
    "head/neck": 1,
    "upper extremity": 2,
    "lower extremity": 3,
    "torso": 4,
    "palms/soles": 5,
    "oral/genital": 6,
}
SEX_VALUES = {"male": 1.0, "female": 0.0, "unknown": 0.5}
SHORT_FEATURES = ("sex", "age_approx", "anatom_site_general_challenge")
FULL_FEATURES = (
    "sex",
    "age_approx",
    "site_head/neck",
    "site_lower extremity",
    "site_oral/genital",
    "site_palms/soles",
    "site_torso",
    "site_upper extremity",
    "site_nan",
)


def quoted(name: str) -> Column:
    """Column by its literal name; site columns hold slashes and spaces."""
    return F.col(f"`{name}`")


def lookup(column: Column, table: Mapping[str, object], default: object) -> Column:
    """Constant dictionary lookup; null and unknown keys take the default."""
    expr = None
    for key, value in table.items():
        hit = column == F.lit(key)
        expr = F.when(hit, F.lit(value)) if expr is None else expr.when(hit, F.lit(value))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def site_code(site: Column) -> Column:
    return lookup(site, SITE_CODES, 0).cast("double")


def site_one_hot(site: Column) -> dict[str, Column]:
    """Seven 0/1 columns; exactly one is 1 for any input."""
    columns = {f"site_{name}": F.coalesce((site == name).cast("int"), F.lit(0)) for name in SITE_CODES}
    columns["site_nan"] = F.when(site.isin(*SITE_CODES), 0).otherwise(1)
    return columns


def sex_value(sex: Column) -> Column:
    return lookup(sex, SEX_VALUES, 0.5)


def age_value(age: Column) -> Column:
    return F.coalesce(age / F.lit(100.0), F.lit(0.0))


def patient_value(patient: Column) -> Column:
    return F.coalesce(patient, F.lit("0"))


def encode_features(df: DataFrame, site_column: str = SITE) -> DataFrame:
    """Replace sex, age and site by numbers and add the one-hot site columns, in one projection."""
    site = quoted(site_column)
    replaced = {
        "sex": sex_value(F.col("sex")),
        "age_approx": age_value(F.col("age_approx")),
        site_column: site_code(site),
    }
    if "patient_id" in df.columns:
        replaced["patient_id"] = patient_value(F.col("patient_id"))
    kept = [replaced.get(c, quoted(c)).alias(c) for c in df.columns]
    return df.select(*kept, *[c.alias(name) for name, c in site_one_hot(site).items()])


def feature_array(features: Sequence[str] = FULL_FEATURES) -> Column:
    return F.array(*[quoted(c).cast("float") for c in features])


def model_input(
    df: DataFrame, features: Sequence[str] = FULL_FEATURES, labelled: bool = True, id_column: str = ID
) -> DataFrame:
    """(id, features) or (id, features, target): unlabelled rows need no target column."""
    columns = [F.col(id_column), feature_array(features).alias("features")]
    return df.select(*columns, F.col("target")) if labelled else df.select(*columns)
