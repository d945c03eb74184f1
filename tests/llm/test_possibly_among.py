from pyspark.sql import functions as F

from rigprep.functions.shared import materialize
from rigprep.llm.exact_dedup import BLOCK_BITS, possibly_among


def test_no_wanted_row_is_lost_and_few_others_stay(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.xxhash64("id").alias("text_hash"), F.lit("x").alias("text"))
    wanted = materialize(rows.where("doc_id % 10 = 0").select("doc_id", "text_hash"), "wanted")
    got = possibly_among(rows, wanted, ["doc_id", "text_hash"])
    assert got.columns == rows.columns
    assert got.where("doc_id % 10 = 0").count() == 2000 and got.count() < 6000
    tight = possibly_among(rows, wanted, ["doc_id", "text_hash"], BLOCK_BITS // 8)
    assert tight.where("doc_id % 10 = 0").count() == 2000


def test_nothing_wanted(spark):
    rows = spark.range(10).select(F.col("id").alias("doc_id"))
    assert possibly_among(rows, materialize(rows.where("false"), "wanted"), ["doc_id"]).count() == 0
