"""Shared by the tests of this folder."""

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


def documents(spark, *texts, **extra):
    """Documents 0, 1, .. in 'en' from source 's'; rows may also be (id, text, lang, source)."""
    rows = [t if isinstance(t, tuple) else (k, t, "en", "s") for k, t in enumerate(texts)]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], DOCS)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)
