"""Line dedup: repeated line runs from prefix doubling over line-ID sequences.

The suffixes of all documents' line sequences are classed by their first line, then by their
first 2, 4, ... lines: the class of ``2h`` lines is the pair of the classes of ``h`` lines at
the position and ``h`` lines on.  Positions alone in their class drop out, so the rounds shrink
to what repeats.  A class at ``min_lines`` lines is an interval of the suffix array whose
longest common prefix has that length; overlapping members make up the maximal repeated runs,
of which every copy but the first in the corpus is deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldgauge.llm.text import count_words, unused
from fieldgauge.session import materialise

#: a run has so many non-blank lines, or is one line of ``MIN_WORDS`` words
MIN_LINES = 2
MIN_WORDS = 50

_PLACE = ["doc_id", "_text", "pos"]


def _is_filled(line: Column) -> Column:
    return F.length(F.trim(F.translate(line, "\t\r\x0b\x0c", "    "))) > 0


def _line_table(docs: DataFrame) -> DataFrame:
    """One row per distinct (doc_id, text) and non-blank line: its number, order and 128-bit id."""
    lines = F.filter(
        F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("line"), x.alias("body"))),
        lambda s: _is_filled(s["body"]),
    )
    return (
        docs.select("doc_id", F.xxhash64("text").alias("_text"), F.posexplode(lines).alias("pos", "at"))
        .select("doc_id", "_text", "pos", F.col("at.line").alias("line"),
                (count_words(F.col("at.body")) >= F.lit(MIN_WORDS)).alias("long"),
                F.unhex(F.md5(F.col("at.body").cast("binary"))).alias("cls"))
    )


def _classes(placed: DataFrame, by: list[str]) -> DataFrame:
    """Places whose ``by`` repeats, with ``cls``: the first place of their class in the corpus."""
    place = F.struct(*_PLACE)
    # written first, so that the join deals both sides anew and a hot class can be split
    groups = materialise(
        placed.groupBy(*by).agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
        .where(F.col("lo") != F.col("hi"))
        .select(*[F.col(c).alias(f"_{c}") for c in by], F.col("lo").alias("_first")),
        "classes",
    )
    same = None
    for c in by:
        one = F.col(c) == F.col(f"_{c}")
        same = one if same is None else same & one
    return placed.join(groups, same).drop(*by, *[f"_{c}" for c in by]).withColumnRenamed("_first", "cls")


def _step(held: DataFrame, h: int) -> DataFrame:
    """Pairs every class with the class ``h`` lines on; suffixes too short drop out."""
    later = held.select(F.col("doc_id").alias("_d"), F.col("_text").alias("_t"),
                        (F.col("pos") - h).alias("_p"), F.col("cls").alias("next"))
    return held.join(
        later,
        F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_text") == F.col("_t")) & (F.col("pos") == F.col("_p")),
    ).drop("_d", "_t", "_p")


def repeated_lines(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """doc_id, _text (hash of the text) and pos of every non-blank line to delete."""
    held = materialise(_classes(_line_table(docs), ["cls"]), "lines")
    is_later = F.struct(*_PLACE) != F.col("cls")
    alone = held.where(F.col("long") & is_later).select(*_PLACE, "line")
    covered, level = 1, held
    while covered < min_lines:
        h = min(covered, min_lines - covered)
        level = materialise(_classes(_step(level, h), ["cls", "next"]), "lines")
        covered += h
    starts = level.where(is_later).select(
        "doc_id", "_text", F.explode(F.sequence("pos", F.col("pos") + (min_lines - 1))).alias("pos")
    )
    # the covered positions repeat too, so their line numbers are among those held
    return starts.distinct().alias("s").join(
        held.select(*_PLACE, "line").alias("h"),
        F.col("s.doc_id").eqNullSafe(F.col("h.doc_id"))
        & (F.col("s._text") == F.col("h._text")) & (F.col("s.pos") == F.col("h.pos")),
    ).select("h.*").unionByName(alone)


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """``docs`` with later copies of repeated line runs taken out of ``text``.

    Every row and column is kept, and two are added: n_lines and n_deleted (non-blank lines);
    columns of ``docs`` with these names give way.
    A run is ``min_lines`` or more non-blank lines, or one line of 50 words, that also starts
    at an earlier place (smaller doc_id, null smallest; same document, earlier line), judged on
    the input.  Blank lines belong to no run and stay.  Rows equal in doc_id and text are one
    document and are treated alike.  A null text stays null, an empty one empty, with 0 lines;
    a text whose lines all go becomes empty.  Only documents with deletions meet their
    decisions, and a document's decisions are bounded by its own lines.
    """
    doc, key, gone = unused(docs, "_doc", "_key", "_gone")
    decided = (
        repeated_lines(docs.select("doc_id", "text"), min_lines).distinct()
        .groupBy("doc_id", "_text").agg(F.collect_set("line").alias(gone))
        .select(F.col("doc_id").alias(doc), F.col("_text").alias(key), gone)
    )
    kept = F.filter(
        F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("line"), x.alias("body"))),
        lambda s: ~F.array_contains(F.col(gone), s["line"]),
    )
    rebuilt = F.array_join(F.transform(kept, lambda s: s["body"]), "\n")
    filled = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), _is_filled))
    joined = docs.join(
        decided, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.xxhash64("text") == F.col(key)), "left"
    )
    columns = [F.when(F.col(gone).isNull(), F.col("text")).otherwise(rebuilt).alias("text") if c == "text"
               else F.col(c) for c in docs.columns if c not in ("n_lines", "n_deleted")]
    # the size of no decision is null, or -1 in older modes
    deleted = F.when(F.col(gone).isNull(), F.lit(0)).otherwise(F.size(gone))
    return joined.select(*columns, filled.cast("long").alias("n_lines"), deleted.cast("long").alias("n_deleted"))
