"""Mix sources to target weights by weighted fair queueing.

Every source queues its documents in a shuffled order, again and again up to
`most` times. A copy of a document finishes at the virtual time at which its
source has been served that far: the words of the source up to its end, by
the words the source is to give. All copies are sorted globally by that time
and the mix ends when the budget is used up, which is at time 1. A copy that
is being served then is taken up to there, so each source meets its target to
the word.

No step depends on how the rows are dealt out. The shuffle is the order of a
hash of the id. Running sums are made in two levels: over slices of a source
by hash, or of the whole mix by time, and within each; no window holds a
whole source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockline.llm.common import WORD
from dockline.session import materialize

# How often a document may come at most, and the weights of the sources in turn.
MOST = 3
WEIGHTS = (1, 2, 3)
# Rows of a source that one window sums up, about, and the most slices of one source; beyond that slices grow.
SLICE_ROWS = 1000
MOST_SLICES = 65_536


def n_words(text: Column) -> Column:
    """Words between ASCII white space; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def running(df: DataFrame, order: Sequence[Column], sums: dict[str, str], tag: str) -> DataFrame:
    """Global running sums: columns `sums[c]` hold what all earlier rows have in column c.

    The rows are range-sorted and written, so that a row's part stays the same;
    a window then runs within each part, and the parts' totals, one row each,
    are summed up before them.
    """
    placed = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    placed = materialize(placed, tag)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_part").agg(*(F.sum(c).alias(f"_{c}_part") for c in sums))
    offsets = totals.select("_part", *(F.coalesce(F.sum(f"_{c}_part").over(before), F.lit(0)).alias(f"_{c}_part") for c in sums))
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = placed.withColumns({new: F.coalesce(F.sum(c).over(within), F.lit(0)) for c, new in sums.items()})
    return own.join(offsets, "_part").withColumns(
        {new: F.col(new) + F.col(f"_{c}_part") for c, new in sums.items()}
    ).drop("_part", *(f"_{c}_part" for c in sums))


def targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST, share: float = 1.0) -> DataFrame:
    """Words that each source is to give: _source, _rank, source_size, target.

    Sources in order of their code points, a null last, have the given weights
    in turn and share `share` of all words. No source gives more than `most`
    times its words; what is left goes to the others by weight. With water
    level l, a source of weight w gives the lesser of w * l and its cap. In
    order of cap by weight, the level that the rest of the budget makes among
    the sources from one on is highest where the open ones begin.
    """
    sizes = sized.groupBy("_source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    sizes = sizes.withColumn("_one", F.lit(1))
    ranked = running(sizes, [F.asc_nulls_last("_source")], {"_one": "_rank"}, "mix-sources")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * F.lit(most))
    order = [F.asc(F.col("_cap") / F.col("_weight")), F.asc("_rank")]
    filled = materialize(running(ranked, order, {"_cap": "_caps", "_weight": "_weights"}, "mix-caps"), "mix-levels")
    left = filled.agg(F.sum("source_size")).scalar() * F.lit(float(share)) - F.col("_caps")
    open_weight = filled.agg(F.sum("_weight")).scalar() - F.col("_weights")
    level = filled.agg(F.max(left / open_weight)).scalar()
    target = F.least(F.col("_cap").cast("double"), F.col("_weight") * level)
    return filled.select("_source", "_rank", "_rows", "source_size", target.alias("target"))


def sized_rows(docs: DataFrame, keep: Sequence[str], source: str, text: str, key: str, seed: str) -> DataFrame:
    """The rows without their texts: kept columns, size, source, and a hash of the key that shuffles them."""
    mixed = F.md5(F.concat_ws(":", F.lit(seed), docs[key].cast("string")))
    return docs.select(
        *(docs[c] for c in keep), docs[source].alias("_source"), n_words(docs[text]).alias("size"), mixed.alias("_hash"),
        docs[key].alias("_key"),
    )


def mix(
    docs: DataFrame, keep: Sequence[str] = ("doc_id",), source: str = "source", text: str = "text", key: str = "doc_id",
    weights: Sequence[float] = WEIGHTS, most: int = MOST, share: float = 1.0, seed: str = "mix",
) -> tuple[DataFrame, DataFrame]:
    """The rows with their sources' targets, and the mix as copies of rows in order.

    Rows: columns `keep`, size, source_size, target, and the row's identity
    (_rank, _slice, _nr). Mix: that identity, `copy` from 0, `finish`, `words`
    taken of the copy, and `position`, the words of the mix before it. A kept
    column that has one of these names gives way. Rows without words are not
    in the mix. Repeated rows count each; rows alike in key and size may
    change places. Without words at all every target is 0.
    """
    made = {"size", "source_size", "target", "taken"}
    keep = [c for c in keep if c not in made]
    sized = materialize(sized_rows(docs, keep, source, text, key, seed), "mix-sizes")
    goals = targets(sized, weights, most, share)
    rows = sized.join(goals, sized["_source"].eqNullSafe(goals["_source"])).drop(goals["_source"])
    # the first 32 bits of the hash, dealt evenly to as many slices as the source needs
    unit = F.conv(F.substring("_hash", 1, 8), 16, 10).cast("bigint")
    slices = F.least(F.floor(F.col("_rows") / SLICE_ROWS) + 1, F.lit(MOST_SLICES))
    rows = rows.withColumn("_slice", F.floor(unit * slices / F.lit(float(1 << 32))))
    slice_sizes = rows.groupBy("_rank", "_slice").agg(F.sum("size").alias("_words"))
    before = Window.partitionBy("_rank").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slice_sizes.select("_rank", "_slice", F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_rank", "_slice").orderBy("_hash", "_key", "size")
    queued = rows.withColumns({
        "_nr": F.row_number().over(within),
        "_start": F.coalesce(F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    }).join(offsets, ["_rank", "_slice"])
    queued = queued.withColumn("_start", F.col("_start") + F.col("_before"))
    queued = materialize(
        queued.select(*keep, "size", "source_size", "target", "_rank", "_slice", "_nr", "_start", "_hash"), "mix-queues")

    copies = queued.where("size > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    start = F.col("_start") + F.col("copy") * F.col("source_size")
    copies = copies.withColumn("_start", start).where(F.col("_start") < F.floor("target")).select(
        "_rank", "_slice", "_nr", "copy", "_hash",
        ((F.col("_start") + F.col("size")) / F.col("target")).alias("finish"),
        F.least("size", F.floor("target") - F.col("_start")).alias("words"),
    )
    order = [F.asc("finish"), F.asc("_hash"), F.asc("_rank"), F.asc("_slice"), F.asc("_nr"), F.asc("copy")]
    served = running(copies, order, {"words": "position"}, "mix-order")
    budget = goals.agg(F.floor(F.sum("source_size") * F.lit(float(share)))).scalar()
    taken = served.withColumn("words", F.least(F.col("words"), budget - F.col("position"))).where("words > 0")
    return queued.drop("_start", "_hash"), taken.drop("_hash")


def taken_words(rows: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows with the words that the mix takes of each, all its copies together."""
    identity = ["_rank", "_slice", "_nr"]
    taken = mixed.groupBy(*identity).agg(F.sum("words").alias("taken"))
    joined = rows.join(taken, identity, "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("bigint"))
    return joined.drop(*identity)
