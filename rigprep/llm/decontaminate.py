"""Benchmark passages in training text, by a positional inverted index, with DataFrame functions only.

The index is a written table of postings (row, pos, term) of the training tokens, for the terms that
the benchmark has: no other list is ever asked for. A benchmark window occurs where its terms' lists
meet after each is shifted by the term's offset. Lists are met from the rarest term on: the rarest
gives the places to try, the second rarest all but ends them, and the others confirm what is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rigprep.functions.shared import materialize

WINDOW = 10
#: What lies between words, once A-Z are lower-cased.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A table of rows of a few numbers (or a word) is broadcast up to so many rows, and joined by shuffles beyond.
BROADCAST_ROWS = 500_000


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, nothing else changed. ``lower`` does it where it leaves the other letters alone."""
    other = F.regexp_replace(text, r"[\x00-\x7F]+", "")
    return F.when(F.lower(other) == other, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    """The array of words of a text; null has none."""
    cut = F.split(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), BREAKS)
    before, after = (F.when(F.element_at(cut, i) == "", 1).otherwise(0) for i in (1, -1))
    return F.slice(cut, before + 1, F.greatest(F.size(cut) - before - after, F.lit(0)))


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a written table), to be broadcast if it has at most ``limit`` rows."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def windows_of(tests: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(windows, items): distinct windows ``(window, words, size)`` and which item has which ``(window, item_id)``.

    Items of fewer words are one window, items without words none; equal windows of many items are one.
    """
    items = tests.select(F.col(id_col).alias("item_id"), words_of(F.col(text_col)).alias("all")).where(F.size("all") > 0)
    k = F.least(F.lit(size), F.size("all"))
    cut = items.withColumn("at", F.explode(F.sequence(F.lit(1), F.size("all") - k + 1))).select("item_id", F.slice("all", F.col("at"), k).alias("words")).distinct()
    cut = materialize(cut, "cut")
    windows = materialize(cut.select("words").distinct().select(F.monotonically_increasing_id().alias("window"), "words", F.size("words").alias("size")), "windows")
    return windows, materialize(cut.join(windows, "words").select("window", "item_id"), "items")


def positional_index(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index as a written table ``(row, pos, term, doc_id)``: every place of every wanted term, whole texts.

    terms: ``(word, term)``, terms from 1 on. Each document has also one row with term 0 whose ``pos`` is its number of words,
    and only that has ``doc_id``. Rows of ``docs`` are told apart by ``row``, so ids may repeat or be null.
    """
    end = F.array(F.lit(""))
    placed = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.concat(words_of(F.col(text_col)), end).alias("words"))
    placed = placed.select("row", "id", F.posexplode("words").alias("pos", "word"))
    ends = terms.sparkSession.range(1).select(F.lit("").alias("word"), F.col("id").alias("term"))
    wanted = small(materialize(terms.select("word", "term").unionByName(ends), "terms"))
    return materialize(placed.join(wanted, "word").select("row", "pos", "term", F.when(F.col("word") == "", F.col("id")).alias("doc_id")), "postings")


def ranked_terms(windows: DataFrame, terms: DataFrame, postings: DataFrame) -> DataFrame:
    """``(window, size, off, term, rank)``: each window's terms, the rarest in the training text first."""
    often = postings.groupBy("term").count()
    of = windows.select("window", "size", F.posexplode("words").alias("off", "word")).join(terms, "word").join(often, "term", "left")
    order = Window.partitionBy("window").orderBy(F.coalesce("count", F.lit(0)), "term", "off")
    return materialize(of.withColumn("rank", F.row_number().over(order)).select("window", "size", "off", "term", "rank"), "ranked")


def vocabulary(windows: DataFrame) -> DataFrame:
    """``(word, term)``: the terms of all windows, numbered from 1."""
    words = windows.select(F.explode("words").alias("word")).distinct()
    return materialize(words.select("word", (F.monotonically_increasing_id() + 1).alias("term")), "vocabulary")


def phrase_matches(postings: DataFrame, ranked: DataFrame) -> DataFrame:
    """``(window, row, start, size)``: every place of every window, exact.

    Offset-adjusted lists are met from the rarest term on. Joins are by row, position and term, which no
    hot term or text can fill; only the rarest term's places are tried for each window.
    """
    places = postings.where("term > 0").select("row", "pos", "term")
    first = small(materialize(ranked.where("rank = 1").select("term", "window", "size", "off"), "first"))
    tried = places.join(first, "term").select("window", "size", "row", (F.col("pos") - F.col("off")).alias("start")).where("start >= 0")
    single = tried.where("size = 1")
    second = materialize(ranked.where("rank = 2").select("window", "off", "term"), "second")
    other = places.join(small(materialize(second.select("term").distinct(), "second")), "term", "left_semi")
    tried = tried.join(small(second), "window").select("window", "size", "row", "start", (F.col("start") + F.col("off")).alias("pos"), "term")
    two = materialize(tried.join(other, ["row", "pos", "term"]).select("window", "size", "row", "start"), "two")
    rest = small(materialize(ranked.where("rank > 2").select("window", "off", "term"), "rest"))
    asked = two.where("size > 2").join(rest, "window").select("window", "size", "row", "start", (F.col("start") + F.col("off")).alias("pos"), "term")
    near = places.join(small(materialize(two.select("row").distinct(), "rows")), "row", "left_semi")
    whole = asked.join(near, ["row", "pos", "term"]).groupBy("window", "size", "row", "start").count().where(F.col("count") == F.col("size") - 2)
    return single.unionByName(two.where("size = 2")).unionByName(whole.drop("count")).select("window", "row", "start", "size")


def proximity_matches(postings: DataFrame, ranked: DataFrame, within: int) -> DataFrame:
    """``(window, row, pos)``: places of a window's rarest term with all its other terms at most ``within`` words away, in any order.

    Positions are dealt into blocks of ``within`` + 1 words and a place meets the terms of its own block and both
    neighbours, so the join is by row, block and term. A term that a window has twice counts once.
    """
    places = postings.where("term > 0").select("row", "pos", "term")
    terms = ranked.groupBy("window", "term").agg(F.min("rank").alias("rank"))
    first = small(materialize(terms.where("rank = 1").select("window", "term"), "first"))
    others = materialize(terms.where("rank > 1").select("window", "term"), "others")
    need = first.join(others.groupBy("window").agg(F.count(F.lit(1)).alias("need")), "window", "left").select("window", F.coalesce("need", F.lit(0)).alias("need"))
    need = small(materialize(need, "need"))
    tried = materialize(places.join(first, "term").select("window", "row", "pos").join(need, "window"), "tried")
    block = lambda c: F.floor(F.col(c) / (within + 1))
    asked = tried.join(small(others), "window").withColumn("block", F.explode(F.array(block("pos") - 1, block("pos"), block("pos") + 1)))
    found = asked.join(places.select("row", "term", F.col("pos").alias("at"), block("pos").alias("block")), ["row", "block", "term"]).where(F.abs(F.col("at") - F.col("pos")) <= within)
    found = found.select("window", "row", "pos", "need", "term").distinct().groupBy("window", "row", "pos", "need").count().where(F.col("count") == F.col("need"))
    return tried.where("need = 0").select("window", "row", "pos").unionByName(found.select("window", "row", "pos"))


def contamination(docs: DataFrame, tests: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, n_hit, n_items, item_ids, contaminated.

    A document word inside any place of a window is hit; n_items counts the items of which a window occurs and
    ``item_ids`` lists them, sorted as strings. Null and empty texts have no words; repeated rows and ids are each judged; without
    items or words nothing is hit; an empty table gives an empty table. Other columns are not looked at.
    """
    windows, items = windows_of(tests, item_col, item_text, size)
    terms = vocabulary(windows)
    postings = positional_index(docs, terms, id_col, text_col)
    found = materialize(phrase_matches(postings, ranked_terms(windows, terms, postings)), "found")
    covered = found.select("row", "start", "size").distinct().select("row", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("size") - 1)).alias("pos")).distinct()
    hit = covered.groupBy("row").agg(F.count(F.lit(1)).alias("n_hit"))
    of = found.select("row", "window").distinct().join(small(items), "window").select("row", F.col("item_id").cast("string").alias("item_id")).distinct()
    of = of.groupBy("row").agg(F.array_sort(F.collect_list("item_id")).alias("item_ids"))
    rows = postings.where("term = 0").select("row", "doc_id", F.col("pos").cast("long").alias("n_words"))
    out = rows.join(materialize(hit, "hit"), "row", "left").join(materialize(of, "of"), "row", "left")
    none = F.array().cast("array<string>")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(F.coalesce("item_ids", none)).cast("long").alias("n_items"), F.coalesce("item_ids", none).alias("item_ids"), F.col("n_hit").isNotNull().alias("contaminated"))


def digests(found: DataFrame) -> DataFrame:
    """``contamination`` with the SHA-256 of the comma-joined items in place of their list."""
    joined = F.array_join("item_ids", ",")
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(joined, 256).alias("items_sha256"), "contaminated")
