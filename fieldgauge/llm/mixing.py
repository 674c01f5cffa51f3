"""Mixing sources to target weights by systematic sampling.

Each document of a source is expected ``target / source size`` times.  The expected copies are
summed in size order within the source, one offset per source is added, and a document is
emitted once per integer boundary its interval crosses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldgauge.llm.ordering import positions
from fieldgauge.llm.text import count_words, unused
from fieldgauge.session import materialise

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """One row per source: source, source_size long, target double.

    ``sized`` has source and size.  Sources in code-point order (null last) weigh ``weights``,
    repeating, and share the total size; a target stops at ``most`` times its source's size and
    the excess is shared again by weight until no target is above.  The level at which the
    sharing settles is found by one aggregate over the source table per round, so sources need
    not fit in one task.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    keyed = per_source.withColumn("_no_source", F.col("source").isNull())
    ranked = materialise(
        positions(keyed, [], ["_no_source", "source"], "_rank").withColumn(
            "_weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
        ),
        "sources",
    )
    cap = F.col("source_size") * most
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, capped = -1.0, -1
    while True:
        stops = cap <= F.col("_weight") * F.lit(level)
        n, fixed, free = ranked.agg(
            F.count(F.when(stops, 1)),
            F.coalesce(F.sum(F.when(stops, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~stops, F.col("_weight"))), F.lit(0)),
        ).first()
        if n == capped or not free:
            break
        capped, level = n, (total - fixed) / free
    share = F.least(cap.cast("double"), F.col("_weight") * F.lit(float(level)))
    return ranked.select("source", "source_size", share.alias("target"))


def offset_of(source: Column, seed: str = "mix") -> Column:
    """One offset in [0, 1) per source, the same in every run."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.concat(F.lit(":"), source), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: str = "mix") -> DataFrame:
    """doc_id, source, size, source_size, target, position and copies of every document.

    Size is the number of words; an empty or null text has size 0 and is dealt copies like any
    other.  A source of size 0 has target 0 and no copies.  Documents are ordered by (size,
    doc_id), nulls first, so the words taken differ from the target by about one document's
    size at most.  Rows that repeat a doc_id are separate documents; among those equal in doc_id
    and size the order does not matter, as they are equal here.  Other columns are not used.
    """
    sized = docs.select("doc_id", "source", count_words(F.col("text")).alias("size"))
    keys = materialise(sized, "sizes")
    placed = positions(keys, ["source"], ["size", "doc_id"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    edge = lambda at: F.floor(offset_of(F.col("source"), seed) + at * F.col("_rate"))
    targets = source_targets(keys, weights, most).withColumnRenamed("source", "_source")
    return (
        placed.join(targets, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_rate", rate)
        .withColumn("copies", edge(F.col("position") + 1) - edge(F.col("position")))
        .select("doc_id", "source", "size", "source_size", "target", "position", "copies")
    )


def emit(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix`` takes it, with ``copy`` counting from 1.

    Rows that share a doc_id are matched to their copies in the order of source and size.  A
    column ``copy`` of ``docs`` gives way.
    """
    unnamed = -(1 << 63)
    ident = F.coalesce(F.col("doc_id").cast("long"), F.lit(unnamed))
    doc, size, nth, key, dealt = unused(docs, "_doc", "_size", "_nth", "_key", "_dealt")
    plan = (
        mix(docs, **options).groupBy(ident.alias(key))
        .agg(F.sort_array(F.collect_list(F.struct("source", "size", "position", "copies"))).alias(dealt))
    )
    within = Window.partitionBy(doc).orderBy("source", size, F.xxhash64("text"))
    numbered = docs.withColumns({doc: ident, size: count_words(F.col("text"))}).withColumn(nth, F.row_number().over(within))
    copies = F.element_at(dealt, F.col(nth))["copies"]
    return (
        numbered.join(plan, F.col(doc) == F.col(key)).where(copies > 0)
        .select(*[c for c in docs.columns if c != "copy"], F.explode(F.sequence(F.lit(1), copies.cast("int"))).alias("copy"))
    )
