import math

import pytest
from pyspark.sql import functions as F

from foldmark.functions import encode
from foldmark.operators import prepare, splits
from foldmark.operators.contracts import duplicate_ids, keep_preferred
from foldmark.schemas import ID, SITE, SampleSet

RAW = f"{ID} string, patient_id string, sex string, age_approx double, {SITE} string, target int"


@pytest.fixture(scope="module")
def raw(spark):
    sites = [*encode.SITE_CODES, "posterior torso", "elbow", None]
    rows = [
        (f"i{i:03d}", None if i % 5 == 0 else f"p{i % 9}", ["male", "female", "unknown", "x", None][i % 5],
         None if i % 7 == 0 else float(i % 80), sites[i % len(sites)], int(i % 6 == 0))
        for i in range(203)
    ]
    return spark.createDataFrame(rows, RAW).cache()


def test_encoding(spark, raw):
    encoded = {r[ID]: r for r in encode.encode_features(raw).collect()}
    for row in raw.collect():
        got = encoded[row[ID]]
        assert got["sex"] == {"male": 1.0, "female": 0.0}.get(row["sex"], 0.5)
        assert got["age_approx"] == (0.0 if row["age_approx"] is None else row["age_approx"] / 100)
        assert got[SITE] == encode.SITE_CODES.get(row[SITE], 0)
        assert got["patient_id"] == (row["patient_id"] or "0")
        flags = {n: got[f"site_{n}"] for n in encode.SITE_CODES} | {"nan": got["site_nan"]}
        assert sum(flags.values()) == 1
        assert flags[row[SITE] if row[SITE] in encode.SITE_CODES else "nan"] == 1


def test_encoding_a_table_alone_equals_encoding_the_union(spark, raw):
    train, test = raw.where("target = 1"), raw.where("target = 0")
    alone = encode.encode_features(train).union(encode.encode_features(test))
    together = encode.encode_features(train.union(test))
    assert sorted(alone.collect()) == sorted(together.collect())


def test_encoding_works_on_a_stream(spark, raw, tmp_path):
    raw.write.parquet(f"{tmp_path}/raw")
    stream = encode.encode_features(spark.readStream.schema(raw.schema).parquet(f"{tmp_path}/raw"))
    query = stream.writeStream.format("memory").queryName("encoded").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert sorted(spark.table("encoded").collect()) == sorted(encode.encode_features(raw).collect())


def test_model_input(spark, raw):
    table = encode.encode_features(raw)
    labelled = encode.model_input(table)
    assert labelled.columns == [ID, "features", "target"]
    assert encode.model_input(table, encode.SHORT_FEATURES, labelled=False).columns == [ID, "features"]
    first = labelled.orderBy(ID).head()
    assert len(first.features) == 9 and dict(labelled.dtypes)["features"] == "array<float>"


def test_drop_columns_must_exist(raw):
    assert "sex" not in prepare.drop_columns(raw, ("sex",)).columns
    with pytest.raises(ValueError, match="nothing"):
        prepare.drop_columns(raw, ("sex", "nothing"))


def test_union_keeps_repeats_and_fills_nulls(spark, raw):
    merged = prepare.union_sources({"a": raw, "b": raw.drop("sex")})
    assert merged.count() == 2 * raw.count()
    assert merged.where("dataset = 'b' and sex is not null").count() == 0


def test_denied_and_duplicates(spark, raw):
    kept = prepare.drop_denied(raw, ["i000", "i007", "absent"])
    assert kept.count() == 201
    doubled = raw.union(raw.limit(3).withColumn("sex", F.lit("zzz")))
    assert duplicate_ids(doubled).count() == 3
    best = keep_preferred(doubled, [ID], [F.col("sex").desc_nulls_last()])
    assert best.count() == 203 and best.where("sex = 'zzz'").count() == 3
    assert "WindowGroupLimit" in best._jdf.queryExecution().executedPlan().toString()


def test_canonical_sites_touch_one_column(raw):
    df = raw.withColumn("sex", F.lit("lateral torso"))
    fixed = prepare.canonical_sites(df)
    assert fixed.where(f"{SITE} like '% torso'").count() == 0
    assert fixed.where("sex = 'lateral torso'").count() == 203


def test_folds_are_even_and_reproducible(spark, raw):
    def folds(df, **kw):
        return {r[ID]: r.fold for r in splits.stratified_folds(df, **kw).collect()}

    got = folds(raw)
    assert got == folds(raw.repartition(13)) and got != folds(raw, seed=48)
    counts = splits.fold_summary(splits.stratified_folds(raw)).collect()
    for label in (0, 1):
        sizes = [r.n for r in counts if r.target == label]
        assert len(sizes) == 8 and max(sizes) - min(sizes) <= 1
    totals = [sum(r.n for r in counts if r.fold == f) for f in range(8)]
    assert max(totals) - min(totals) <= 1


def test_sanity_flag(raw):
    df = prepare.flag_sanity_rows(splits.stratified_folds(raw).withColumn("dataset", F.lit("a")))
    assert df.count() == 203
    flagged = prepare.sanity_rows(df)
    assert flagged.count() == 32
    assert {r["count"] for r in flagged.groupBy("fold", "target").count().collect()} == {2}


def test_prepared_table(spark, raw):
    tables = {
        "a": raw.where(f"{ID} < 'i100'").withColumns({c: F.lit(None) for c in ("diagnosis", "tfrecord")}),
        "b": raw.where(f"{ID} >= 'i100'").drop("patient_id").withColumns(
            {c: F.lit(None) for c in ("benign_malignant", "width", "height")}
        ),
    }
    assert prepare.prepare_training_table(tables).count() == 203
    table = prepare.prepare_training_table(tables, denied=["i000"])
    assert table.count() == 202
    assert set(table.columns) == {*raw.columns, "dataset", "fold", "sanity_check"}


def test_splits(raw):
    source = SampleSet(splits.stratified_folds(raw), {"a": "/x"}, tuple(range(8)))
    train, validation = splits.train_validate_split(source)
    assert (train.folds, validation.folds) == ((2, 3, 4, 5, 6, 7), (0, 1))
    assert train.count() + validation.count() == source.count() and train.roots == source.roots
    assert splits.complement_folds([0, 9]) == list(range(1, 8))
    assert splits.distinct_folds(source.df) == list(range(8))

    pairs = [v.folds for _, v in splits.kfold_splits(source, 4)]
    assert pairs == [(0, 1), (2, 3), (4, 5), (6, 7)]
    for n in (4, 8):
        indexed = splits.with_val_index(source.df, n)
        for i in range(n):
            _, validation = splits.pick_split(source, i, n)
            assert validation.df.count() == indexed.where(F.col("val_index") == i).count()
    for bad in (0, 1, 5, 16):
        with pytest.raises(ValueError):
            splits.kfold_splits(source, bad)
        with pytest.raises(ValueError):
            splits.with_val_index(source.df, bad)
    with pytest.raises(ValueError):
        splits.pick_split(source, 4, 4)


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6, 203])
def test_holdout_size(spark, raw, n):
    df = raw.orderBy(ID).limit(n)
    got = splits.holdout_split(df)
    assert got.count() == n
    assert got.where("is_test").count() == math.ceil(round(0.2 * n, 9))


def test_split_filters_prune_partitions(spark, raw, tmp_path):
    from foldmark.sinks.tables import write_prepared

    write_prepared(splits.stratified_folds(raw), f"{tmp_path}/prepared")
    source = SampleSet(spark.read.parquet(f"{tmp_path}/prepared"))
    _, validation = splits.pick_split(source, 1, 4)
    plan = validation.df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [fold" in plan or "PartitionFilters: [cast(fold" in plan
    assert splits.head_rows(validation.df, 3).count() == 3


def test_head_of_each_split(spark):
    df = spark.createDataFrame([(f"i{i:02}", i % 2) for i in range(20)], "image_name string, val_index int")
    got = sorted((r.val_index, r.image_name) for r in splits.head_rows(df, 3, split=("val_index",)).collect())
    assert got == [(0, "i00"), (0, "i02"), (0, "i04"), (1, "i01"), (1, "i03"), (1, "i05")]
