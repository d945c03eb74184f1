"""Bands of the quality rules, fitted on a labelled table and reported on the half that was held out."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rigprep.functions.shared import materialize
from rigprep.llm import quality

#: Good texts keep so much distance from their band: characters a token, byte share, bits.
MARGIN = (0.05, 0.02, 0.05)
MOST_CHARS = 9.0
#: A language needs so many good texts for a band, and so many languages get one at most.
LEAST_GOOD, MAX_LANGS = 30, 200


def measured(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The measures of labelled texts that pass the base rule, with lang, good and held_out (half of the ids, by crc32)."""
    marks = labels.where(F.col(label_col).isNotNull()).select(F.col(id_col).alias("label_id"), (F.col(label_col) == 1).alias("good")).distinct()
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).join(marks, F.col("doc_id") == F.col("label_id")).drop("label_id")
    key = F.struct("doc_id", "lang", "good").alias("doc_id")
    found = quality.fertility_rules(given.select(key, "text", "lang")).where("not base_failed")
    return found.select("doc_id.*", "script", "n_words", "n_tokens", "chars_per_token", "byte_share", "token_entropy").withColumn("held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 1)


def _length(n_tokens: str) -> Column:
    low, high = quality.CURVE
    return F.least(F.greatest(F.log2(F.greatest(F.col(n_tokens), F.lit(1))), F.lit(low)), F.lit(high))


def fit_bands(texts: DataFrame, max_langs: int = MAX_LANGS) -> dict:
    """Bands by language of ``texts`` (as ``measured`` gives them), beside the script bands of ``quality.BANDS``.

    Of the good texts that are not held out: the least characters a token and the largest byte share, with a margin, and a
    parabola of the entropy over the length (least squares), lowered until all of them lie above it. All is by sums, and
    the driver gets a row for each language.
    """
    x, y = _length("n_tokens"), F.col("token_entropy")
    good = texts.where("good and not held_out and lang is not null")
    sums = [F.sum(F.pow(x, F.lit(k))).alias(f"x{k}") for k in range(5)] + [F.sum(F.pow(x, F.lit(k)) * y).alias(f"y{k}") for k in range(3)]
    edge = [F.min("chars_per_token").alias("chars"), F.max("byte_share").alias("bytes"), F.count(F.lit(1)).alias("n")]
    rows = good.groupBy("lang").agg(*edge, *sums).where(F.col("n") >= LEAST_GOOD).orderBy(F.desc("n"), "lang").limit(max_langs).collect()
    curves = {}
    for r in rows:
        normal = np.array([[r[f"x{i + j}"] for j in range(3)] for i in range(3)])
        curves[r["lang"]] = np.linalg.lstsq(normal, np.array([r[f"y{i}"] for i in range(3)]), rcond=None)[0]
    if not curves:
        return dict(quality.BANDS)
    table = good.sparkSession.createDataFrame([(k, *map(float, v)) for k, v in curves.items()], "lang string, a double, b double, c double")
    under = good.join(F.broadcast(table), "lang").groupBy("lang").agg(F.min(y - F.col("a") - F.col("b") * x - F.col("c") * x * x).alias("low")).collect()
    low = {r["lang"]: r["low"] for r in under}
    bands = {k: v for k, v in quality.BANDS.items() if k in ("latin", "cyrillic", "cjk", "other")}
    for r in rows:
        a, b, c = curves[r["lang"]]
        bands[r["lang"]] = (r["chars"] - MARGIN[0], MOST_CHARS, r["bytes"] + MARGIN[1], (float(a + low[r["lang"]] - MARGIN[2]), float(b), float(c)))
    return bands


def band_report(texts: DataFrame, bands: dict) -> DataFrame:
    """``(lang, held_out, good, texts, rejected)``: how the bands judge both halves, false rejections among the good ones."""
    names = spark_bands(texts, bands)
    x = _length("n_tokens")
    floor = F.col("a") + F.col("b") * x + F.col("c") * x * x
    out = (F.col("chars_per_token") < F.col("least")) | (F.col("chars_per_token") > F.col("most")) | (F.col("byte_share") > F.col("bytes")) | (F.col("token_entropy") < floor)
    return texts.join(F.broadcast(names), F.col("lang") == F.col("band_lang")).groupBy("lang", "held_out", "good").agg(F.count(F.lit(1)).alias("texts"), F.count_if(out).alias("rejected"))


def spark_bands(texts: DataFrame, bands: dict) -> DataFrame:
    """Bands of languages as a written table, one row each."""
    rows = [(k, *map(float, v[:3]), *map(float, v[3] if isinstance(v[3], tuple) else (v[3], 0.0, 0.0))) for k, v in bands.items()]
    return materialize(texts.sparkSession.createDataFrame(rows, "band_lang string, least double, most double, bytes double, a double, b double, c double"), "bands")
