"""Mixing sources by temperature, with DataFrame functions only.

A source's weight is its token share to the power of an exponent, normalised. The exponent is
found by bisection (many points a round) over aggregates of the source table: the flattest
mixture in which no source repeats more than a limit, or the one with a wanted entropy. Weights
are realised by budgets: a source's documents lie in blocks, each epoch permutes the blocks, and
the last epoch stops where the budget does, inside one block.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rigprep.functions.shared import materialize

#: Blocks of a source: a window over blocks has so many rows, and only one block in so many is cut.
BLOCKS = 1024
POINTS, ROUNDS = 33, 5
#: Block tables up to so many rows are broadcast (their rows are under 200 bytes).
BROADCAST_ROWS = 100_000
MADE = ("mix_source", "mix_weight", "mix_repeats", "mix_epoch", "mix_block", "mix_rank")


@dataclass(frozen=True)
class Target:
    """Either the most often that a source may repeat (relative to the least repeated one) or an entropy in bits."""

    repetition: float | None = 1.5
    entropy_bits: float | None = None


def n_tokens(text: Column) -> Column:
    """Words outside ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def block_of(id_col: str, seed: int, blocks: int = BLOCKS) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(blocks)).cast("int")


def fit_exponent(shares: DataFrame, target: Target) -> float:
    """The exponent in [0, 1] for ``shares`` (column share, positive): 1 keeps the shares, 0 levels them.

    Both the spread of repetitions and the distance from an even mixture fall as the exponent
    falls or rises, so each round looks at POINTS exponents at once and keeps one step.
    """
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        grid = [low + (high - low) * k / (POINTS - 1) for k in range(POINTS)]
        at = shares.select("share", F.explode(F.array(*map(F.lit, grid))).alias("a"))
        power = F.pow("share", F.col("a"))
        seen = at.groupBy("a").agg(
            F.sum(power).alias("z"),
            F.sum(power * F.log("share")).alias("s"),
            F.max((F.col("a") - 1) * F.log("share")).alias("most"),
            F.min((F.col("a") - 1) * F.log("share")).alias("least"),
        )
        rows = sorted(seen.select("a", F.exp(F.col("most") - F.col("least")).alias("repeats"), ((F.log("z") - F.col("a") * F.col("s") / F.col("z")) / F.log(F.lit(2.0))).alias("bits")).collect())
        if not rows:
            return 1.0
        if target.entropy_bits is not None:  # the largest exponent that is even enough
            good = [r.a for r in rows if r.bits >= target.entropy_bits - 1e-12]
            if not good:
                return 0.0
            low, high = max(good), min([r.a for r in rows if r.a > max(good)], default=max(good))
            found = low
        else:  # the smallest exponent that repeats seldom enough
            good = [r.a for r in rows if r.repeats <= target.repetition + 1e-12]
            found = high = min(good)
            low = max([r.a for r in rows if r.a < found], default=found)
        if low == high:
            break
    return found


def mix(docs: DataFrame, target: Target = Target(), budget_tokens: float | None = None, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", blocks: int = BLOCKS) -> DataFrame:
    """``docs`` with mix_source, mix_weight, mix_repeats, mix_epoch, mix_block and mix_rank: a row for each use.

    mix_repeats is how many epochs a source's budget pays for, mix_rank the place of the block in
    the epoch's permutation. Without ``budget_tokens`` the budget is the least that uses every
    document at least once; with it, a source whose budget is under one epoch is cut. A document is
    used if the budget is not yet spent when its turn comes, so each source may exceed its share of the budget by its
    last document; rows that repeat an id take the same turn. A null
    source counts as the empty name. Sources without tokens have weight 0 and pass once. Repeated rows
    are used each; an empty table gives an empty table. Columns of ``docs`` that have a name of the new ones
    are replaced.

    The hot source is spread over its blocks, and its counts are pre-aggregated in each task.
    """
    others = [c for c in docs.columns if c not in MADE]
    doc_id, text = F.col("mix_row")[id_col], F.col("mix_row")[text_col]
    marked = docs.select(F.struct(*[docs[c] for c in others]).alias("mix_row"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("mix_source"), block_of(id_col, seed, blocks).alias("mix_block"))
    counts = materialize(marked.groupBy("mix_source", "mix_block").agg(F.sum(n_tokens(text)).alias("tokens")), "blocks")
    everything = counts.agg(F.sum("tokens")).first()[0]
    sources = counts.groupBy("mix_source").agg(F.sum("tokens").alias("total")).withColumn("share", F.col("total") / F.lit(everything or None).cast("double"))
    sources = materialize(sources, "sources")
    live = sources.where("total > 0")
    exponent = fit_exponent(live.select("share"), target)
    sums = live.agg(F.sum(F.pow("share", F.lit(exponent))).alias("z"), F.max(F.col("total") / F.pow("share", F.lit(exponent))).alias("most")).first()
    z = sums["z"] or 1.0
    budget = budget_tokens if budget_tokens is not None else (sums["most"] or 0.0) * z
    weight = F.when(F.col("total") > 0, F.pow("share", F.lit(exponent)) / z).otherwise(0.0)
    planned = sources.withColumn("mix_weight", weight).withColumn("mix_repeats", F.when(F.col("total") > 0, F.lit(float(budget)) * F.col("mix_weight") / F.col("total")).otherwise(1.0))
    planned = planned.withColumn("whole", F.floor(F.col("mix_repeats") + 1e-9)).withColumn("quota", F.greatest(F.lit(0.0), F.col("mix_repeats") - F.col("whole")) * F.col("total"))
    planned = planned.withColumn("epochs", (F.col("whole") + F.when(F.col("quota") > 1e-6 * F.col("total"), 1).otherwise(0)).cast("int")).where("epochs > 0")
    turn = counts.join(planned, "mix_source").withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), F.col("epochs") - 1)))
    order = Window.partitionBy("mix_source", "mix_epoch").orderBy(F.xxhash64("mix_source", "mix_block", "mix_epoch", F.lit(seed)), "mix_block")
    turn = turn.withColumn("mix_rank", (F.row_number().over(order) - 1).cast("int")).withColumn("before", F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    left = F.when(F.col("mix_epoch") < F.col("whole"), F.col("total") + 1.0).otherwise(F.col("quota")) - F.col("before")
    turn = turn.withColumn("__left", left).where("__left > 0").select("mix_source", "mix_block", "mix_weight", "mix_repeats", "mix_epoch", "mix_rank", "__left", (F.col("tokens") > F.col("__left")).alias("__cut"))
    turn = materialize(turn, "turns")
    if turn.count() <= BROADCAST_ROWS:
        turn = F.broadcast(turn)
    used = marked.join(turn, ["mix_source", "mix_block"])
    # of the block that the budget cuts, ids and token counts alone are put in order; its last turn is the limit
    place = F.struct(F.xxhash64(doc_id, "mix_epoch", F.lit(seed)).alias("h"), doc_id.alias("id"))
    inside = Window.partitionBy("mix_source", "mix_epoch").orderBy("__place").rowsBetween(Window.unboundedPreceding, -1)
    small = used.where("__cut").select("mix_source", "mix_epoch", "__left", place.alias("__place"), n_tokens(text).alias("n"))
    limit = small.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0))).where("before < __left").groupBy("mix_source", "mix_epoch").agg(F.max("__place").alias("__limit"))
    limit = materialize(limit, "limits")
    cut = used.where("__cut").join(limit, ["mix_source", "mix_epoch"]).where(place <= F.col("__limit"))
    return used.where("not __cut").select("mix_row.*", *MADE).unionByName(cut.select("mix_row.*", *MADE))
