"""Exact duplicates by two-pass Bloom filtering, with DataFrame functions only.

Pass one sets bits: each text hash has a slot in a filter, which keeps the slots that were hit at
least twice. Pass two tests every hash: if its slot was hit twice the text is possibly repeated and
its digest goes to an exact grouping; every other row passes straight through. A filter can only err
towards "possibly", so the result is exact. Filters have a bounded size: hashes that need more are
taken slice by slice of their values, each with a filter of its own, so no input is too large for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rigprep.functions.shared import materialize, new_path, shuffles_go
from rigprep.llm.text import text_hash, without_rows

BLOCK_BITS = 32768  # of one bitmap of bitmap_construct_agg
#: With one hash to a filter, one lone row in so many is sent to the grouping by chance.
BITS_PER_ROW = 16
#: A filter that is broadcast has so many bytes at most.
BROADCAST_BYTES = 64 << 20


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def filter_bits(rows: int) -> int:
    """Bits of one filter: whole blocks, at least BITS_PER_ROW for each row."""
    return BLOCK_BITS * max(1, -(-BITS_PER_ROW * rows // BLOCK_BITS))


def slot(hash_col: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.col(hash_col), F.lit(0)), F.lit(bits)) + 1


def repeated_slots(hashes: DataFrame, hash_col: str, bits: int) -> DataFrame:
    """The filter as a table ``(block, bitmap)`` of slots that were hit at least twice.

    Equal slots of a task are one record; a record is two numbers.
    """
    twice = hashes.groupBy(slot(hash_col, bits).alias("slot")).count().where("count > 1")
    return twice.groupBy(F.bitmap_bucket_number("slot").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap"))


def bit_is_set(bitmap: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.pmod(F.floor(byte / F.pow(F.lit(2), position % 8)), F.lit(2)), F.lit(0)) == 1


def _tested(hashes: DataFrame, hash_col: str, bits: int) -> DataFrame:
    """``hashes`` with ``maybe``, by a filter that is broadcast: ``bits`` bound its size."""
    blocks = F.broadcast(materialize(repeated_slots(hashes, hash_col, bits), "bloom").toDF("__block", "__bitmap"))
    at = slot(hash_col, bits)
    out = hashes.join(blocks, F.bitmap_bucket_number(at) == F.col("__block"), "left")
    return out.select(*hashes.columns, bit_is_set(F.col("__bitmap"), F.bitmap_bit_position(at)).alias("maybe"))


def with_possibly_repeated(hashes: DataFrame, hash_col: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``hashes`` (a written table) with a boolean ``maybe``: false means that the hash surely stands alone."""
    rows = hashes.count()
    slices = -(-filter_bits(rows) // (8 * max(broadcast_bytes, BLOCK_BITS // 8)))
    if slices == 1:
        return _tested(hashes, hash_col, filter_bits(rows))
    spark = hashes.sparkSession
    cut, out = new_path(spark, "slices"), new_path(spark, "tested")
    with shuffles_go(spark):  # written by slice, so that each slice's rows are read twice and no others
        hashes.withColumn("__slice", F.pmod(F.xxhash64(F.col(hash_col), F.lit(1)), F.lit(slices))).write.partitionBy("__slice").parquet(cut)
        for k in range(slices):
            part = spark.read.schema(T.StructType([*hashes.schema, T.StructField("__slice", T.LongType())])).parquet(cut).where(F.col("__slice") == k).drop("__slice")
            _tested(part, hash_col, filter_bits(2 * rows // slices)).write.mode("append").parquet(out)
    return spark.read.parquet(out)


def possibly_among(rows: DataFrame, wanted: DataFrame, keys: list[str], broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Those of ``rows`` whose ``keys`` are possibly in ``wanted`` (a written table), by a filter that is broadcast.

    No row of ``wanted``'s keys is lost; a few others stay, as they do where the filter's bound leaves it fewer bits
    a row. So a join that follows shuffles the rows that it needs and not all.
    """
    bits = min(filter_bits(wanted.count()), 8 * max(broadcast_bytes, BLOCK_BITS // 8))
    at = F.pmod(F.xxhash64(*keys), F.lit(bits)) + 1
    blocks = wanted.select(at.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("__block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("__bitmap"))
    found = rows.join(F.broadcast(materialize(blocks, "bloom")), F.bitmap_bucket_number(at) == F.col("__block"))
    return found.where(bit_is_set(F.col("__bitmap"), F.bitmap_bit_position(at))).select(*rows.columns)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, text_hash, keep_hash (of the row that stays).

    Texts are equal when their normalised forms are. Of equal texts the row with the smallest
    id stays (null ids come last; of rows with the same id and text, one). A null text counts
    as empty and empty texts are equal to each other. An empty table gives an empty table.
    Other columns of ``docs`` are not looked at.

    Texts are read once and never shuffled: their digests are written to the shared folder, and
    of the digests only possibly repeated ones are grouped. A hot text is pre-aggregated in each
    task, and the written groups let AQE split its rows when they fetch their group.
    """
    digests = materialize(
        docs.select(F.col(id_col).alias("doc_id"), F.sha2(normalised(F.col(text_col)), 256).alias("text_sha256"), text_hash(text_col).alias("text_hash"), F.monotonically_increasing_id().alias("row")),
        "digests",
    )
    marked = materialize(with_possibly_repeated(digests, "text_sha256", broadcast_bytes), "marked")
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("doc_id"), F.col("row").alias("row"), F.col("text_hash").alias("text_hash"))
    maybe = marked.where("maybe")
    groups = materialize(maybe.groupBy("text_sha256").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1"), "groups")
    found = maybe.join(groups, "text_sha256", "left").select(
        "doc_id",
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("first.row") == F.col("row"), F.lit(True)).alias("kept"),
        "text_sha256",
        "text_hash",
        F.coalesce("first.text_hash", "text_hash").alias("keep_hash"),
    )
    alone = marked.where("not maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256", "text_hash", F.col("text_hash").alias("keep_hash"))
    return alone.unionByName(found)


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, that of the smallest id; all columns stay.

    Rows go by id and text together, and of rows that repeat the id and text that stays, one stays: which one is
    not promised. Null ids come last and are rows like others: of null ids with one text, one row stays.
    """
    found = materialize(exact_duplicates(docs, id_col, text_col).where("not kept"), "not_kept")
    same = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("text_hash") == F.col("keep_hash"))
    gone, twice = (materialize(found.where(x).select("doc_id", "text_hash").distinct(), "gone") for x in (~same, same))
    return without_rows(docs, id_col, text_col, gone, twice)
