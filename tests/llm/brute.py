"""Small helpers of the brute-force tests: a session table from rows, rows of a result by key."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _chunk string, _tie string, part int"


def docs_of(spark, rows, partitions=3):
    """Documents with extra columns whose names clash with the operators' own."""
    data = [(i, t, "en", "src0", None if t is None else len(t), "c", "t", 7) for i, t in rows]
    return spark.createDataFrame(data, DOCS).repartition(partitions)


def rows_of(df):
    return [r.asDict() for r in df.collect()]
