"""Mixing sources to target weights (weighted sampling without replacement).

Method: Efraimidis-Spirakis.  Every document draws u in (0, 1) from a hash of
its id and gets the exponential key ``-ln(u) / weight``, where ``weight`` is its
quality weight; taking documents by ascending key is sampling without
replacement in proportion to the weights.  Per source the sizes are
prefix-summed in key order up to the source's token budget.  A budget larger
than the source is served by complete epochs first; only the remaining fraction
of an epoch is selected by key.

Budgets: sources in code-point order (null last) weigh ``cycle`` repeated and
share ``share`` of all tokens; no target exceeds ``max_epochs`` times its
source, the excess goes to the other sources by weight until none is above.
That is the level L with ``sum(min(cap, L * weight)) = total``, found in one
sorted pass over the table of sources.

Scale: no source is ever sorted in one task.  Documents equal in key, id and size
are one class, counted map-side, so copies cost nothing.  Keys fall into logarithmic
buckets (relative width, so any scale of weights spreads); bucket totals give
each bucket its start, and only classes of one (source, bucket) are ordered
together.  The number of buckets grows with the input and does not change the
result.  The outcome per source is one row: complete epochs, the last class that is
selected whole, and how many of the next one.  Documents are compared with that row,
so texts are never shuffled.  The join on the source is salted: one source may hold
any share of the rows.  Only where a budget ends inside a class are the documents of
that class numbered, in ranges that any number of copies spreads over.

Defined cases: a null text has size 0; a null id draws from a hash of the text in its
place; a null, zero, negative or NaN weight sorts last, in random order; of documents
equal in key, id and size as many are taken as come nearest to the budget; a source
without tokens has target 0; an empty input gives an empty result.  :func:`mix` carries the input row as one struct, so
its columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripstar.llm.common import cut_lineage
from tripstar.operators.ranges import running_sum

SALTS = 32
LAST_KEY = 1e300
BUCKET_ROWS = 50_000


def exponential_key(drawn_id: Column, weight: Column, seed: int = 42) -> Column:
    """``-ln(u) / weight`` with u from 52 bits of md5(seed:id); unusable weights lie beyond all others."""
    text = F.concat(F.lit(f"{seed}:"), drawn_id)
    u = (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    usable = weight.isNotNull() & ~F.isnan(weight.cast("double")) & (weight > 0)
    return F.when(usable, F.least(-F.log(u) / weight.cast("double"), F.lit(LAST_KEY))).otherwise(F.lit(LAST_KEY) * (1 + u))


def mix_rows(docs: DataFrame, size: Column, weight: Column, id_col: str = "doc_id",
             source_col: str = "source", seed: int = 42, text_col: str = "text") -> DataFrame:
    """Input columns plus what the plan needs.  The source key sorts null last."""
    drawn = F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    return docs.withColumns({
        "_mix_src": F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("t")),
        "_mix_size": F.coalesce(size.cast("long"), F.lit(0).cast("long")),
        "_mix_key": exponential_key(drawn, weight, seed),
        "_mix_id": drawn,
    })


def targets(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3,
            share: float = 1.0) -> DataFrame:
    """One row per source (``_mix_src``, ``_mix_total``) -> plus ``_mix_target``.

    The windows run over the list of sources, one row each, not over documents.
    """
    everything = Window.partitionBy(F.lit(0))
    ranked = sources.withColumn("_rank", F.row_number().over(everything.orderBy("_mix_src")))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), ((F.col("_rank") - 1) % len(cycle) + 1).cast("int"))
    caps = ranked.withColumns({
        "_w": weight,
        "_cap": F.col("_mix_total") * max_epochs,
    }).withColumn("_ratio", F.col("_cap") / F.col("_w"))
    by_ratio = everything.orderBy("_ratio", "_mix_src")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levels = caps.withColumns({
        "_budget": F.sum("_mix_total").over(everything) * F.lit(float(share)),
        "_capped": F.coalesce(F.sum("_cap").over(before), F.lit(0)),
        "_open": F.sum("_w").over(rest),
    }).withColumn("_level", (F.col("_budget") - F.col("_capped")) / F.col("_open"))
    # the first source whose cap lies above its level fixes the common level
    fixed = F.min(F.when(F.col("_ratio") > F.col("_level"), F.struct("_ratio", "_mix_src", "_level"))).over(everything)
    level = levels.withColumn("_final", fixed["_level"])
    cap = F.col("_cap").cast("double")
    target = F.when(F.col("_final").isNull(), cap).otherwise(F.least(cap, F.col("_final") * F.col("_w")))
    return level.select("_mix_src", "_mix_total", target.alias("_mix_target"))


def mix_plan(spark: SparkSession, rows: DataFrame, cycle: tuple[int, ...] = (1, 2, 3),
             max_epochs: int = 3, share: float = 1.0, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Per source: total, target, complete epochs and the last key of the fraction."""
    slim = rows.select("_mix_src", "_mix_size", "_mix_key", "_mix_id")
    # buckets per factor e of the key; a plan detail that follows the input's size
    fine = slim.agg(F.greatest(F.lit(64), F.ceil(F.count(F.lit(1)) / bucket_rows)).cast("int")).scalar()
    slim = slim.withColumn("_mix_bucket", F.floor(F.log(F.col("_mix_key")) * fine))
    # documents that the order cannot tell apart
    classes = slim.groupBy("_mix_src", "_mix_bucket", "_mix_key", "_mix_id", "_mix_size").agg(F.count(F.lit(1)).alias("_n"))
    buckets = slim.groupBy("_mix_src", "_mix_bucket").agg(F.sum("_mix_size").alias("_tokens"))
    totals = buckets.groupBy("_mix_src").agg(F.sum("_tokens").alias("_mix_total"))
    goal = targets(totals, cycle, max_epochs, share)
    goal = goal.withColumn("_mix_epochs", F.when(F.col("_mix_total") > 0, F.floor(F.col("_mix_target") / F.col("_mix_total"))).otherwise(F.lit(0)).cast("long"))
    goal = goal.withColumn("_rest", F.col("_mix_target") - F.col("_mix_epochs") * F.col("_mix_total"))
    run = Window.partitionBy("_mix_src").orderBy("_mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.withColumn("_start", F.coalesce(F.sum("_tokens").over(run), F.lit(0)))
    # a bucket that starts beyond the rest of the budget selects nothing
    starts = starts.join(goal, "_mix_src").where(F.col("_start") < F.col("_rest"))
    order = Window.partitionBy("_mix_src", "_mix_bucket").orderBy("_mix_key", "_mix_id", "_mix_size")
    inside = classes.join(starts.select("_mix_src", "_mix_bucket", "_start", "_rest"), ["_mix_src", "_mix_bucket"])
    earlier = F.coalesce(F.sum(F.col("_n") * F.col("_mix_size")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # nearest to the budget: a document is in if at least half of it fits
    room = F.col("_rest") - F.col("_start") - earlier
    fits = F.when(F.col("_mix_size") == 0, F.when(room > 0, F.col("_n")).otherwise(0)).otherwise(
        F.least(F.col("_n"), F.floor(room / F.greatest(F.col("_mix_size"), F.lit(1)) + 0.5)))
    chosen = inside.withColumn("_fits", fits.cast("long")).where(F.col("_fits") > 0)
    here = F.struct("_mix_key", "_mix_id", "_mix_size")
    last = chosen.groupBy("_mix_src").agg(
        F.max(F.when(F.col("_fits") == F.col("_n"), here)).alias("_mix_last"),
        F.max(F.when(F.col("_fits") < F.col("_n"), F.struct(here.alias("cut"), F.col("_fits").alias("part")))).alias("_mix_part"))
    goal = goal.drop("_rest").join(last, "_mix_src", "left")
    return goal.select("_mix_src", "_mix_total", "_mix_target", "_mix_epochs", "_mix_last", F.col("_mix_part.cut").alias("_mix_cut"),
                       F.col("_mix_part.part").alias("_mix_part"))


def mix_apply(rows: DataFrame, plan: DataFrame, salts: int = SALTS) -> DataFrame:
    """Rows plus ``_mix_copies``: how often the mix takes the document."""
    plan = cut_lineage(rows.sparkSession, plan)  # a row per source
    cuts = plan.where("_mix_cut is not null").count()
    salted = plan.withColumn("_mix_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = rows.withColumn("_mix_salt", F.pmod(F.xxhash64("_mix_id", "_mix_size"), F.lit(salts)).cast("int"))
    joined = rows.join(salted, ["_mix_src", "_mix_salt"], "left")
    here = F.struct("_mix_key", "_mix_id", "_mix_size")
    epochs = F.coalesce(F.col("_mix_epochs"), F.lit(0).cast("long"))
    whole = F.coalesce((here <= F.col("_mix_last")).cast("long"), F.lit(0).cast("long"))
    if not cuts:
        return joined.withColumn("_mix_copies", epochs + whole).drop("_mix_cut", "_mix_part")
    at_cut = F.coalesce(here == F.col("_mix_cut"), F.lit(False))
    others = joined.where(~at_cut).withColumn("_mix_copies", epochs + whole)
    tied = joined.where(at_cut).withColumns({"_mix_one": F.lit(1).cast("long"), "_mix_tie": F.monotonically_increasing_id()})
    tied = running_sum(tied, ["_mix_src"], [F.col("_mix_tie").asc()], "_mix_one", "_mix_place")
    tied = tied.withColumn("_mix_copies", epochs + (F.col("_mix_place") <= F.col("_mix_part")).cast("long"))
    return others.unionByName(tied.drop("_mix_one", "_mix_tie", "_mix_place")).drop("_mix_cut", "_mix_part")


def mix(spark: SparkSession, docs: DataFrame, size: Column, weight: Column, id_col: str = "doc_id",
        source_col: str = "source", seed: int = 42, text_col: str = "text", **plan) -> DataFrame:
    """The mix itself: every document repeated as often as it is taken."""
    rows = mix_rows(docs.select(
        F.struct("*").alias("_mix_row"), F.col(id_col).alias("_mix_doc"), F.col(source_col).alias("_mix_source"),
        F.col(text_col).alias("_mix_text"), size.alias("_mix_n"), weight.alias("_mix_w")),
        F.col("_mix_n"), F.col("_mix_w"), "_mix_doc", "_mix_source", seed, "_mix_text").drop("_mix_text")
    slim = cut_lineage(spark, rows.select("_mix_src", "_mix_size", "_mix_key", "_mix_id"))
    taken = mix_apply(rows, mix_plan(spark, slim, **plan)).where(F.col("_mix_copies") > 0)
    copies = F.sequence(F.lit(1).cast("long"), F.col("_mix_copies"))
    return taken.select("_mix_row", F.explode(copies).alias("_mix_copy")).select("_mix_row.*")


def letter_weight(text: Column) -> Column:
    """A quality weight of a text: its share of letters, smoothed."""
    text = F.coalesce(text, F.lit(""))
    return (F.length(F.regexp_replace(text, "[^A-Za-z]+", "")) + 1) / (F.length(text) + 1)
