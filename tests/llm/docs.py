"""Small tables that every operator must take."""

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def documents(spark, rows, extra=False):
    """rows: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(*r, *(None, None)[: 4 - len(r)], len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    if extra:  # names that operators use inside
        for c in ("row", "part", "rank", "key", "hash", "kept", "start", "length", "component", "label", "a", "b", "node", "words", "class", "base", "tokens", "url_", "gone_id"):
            df = df.withColumn(c, df.doc_id.cast("string"))
    return df
