"""Line de-duplication: lines that many documents share stay in one document only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import BLANKS, lower_ascii
from tickloom.session import staged


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        min_docs: int = 2, min_chars: int = 10) -> DataFrame:
    """``docs`` without the lines that ``min_docs`` documents or more hold, plus ``n_lines``
    (before) and ``n_dropped``.

    Lines end at ``\\n``. A line's key is the line without blanks at both ends, A-Z lower-cased.
    Keys of ``min_chars`` code points or more that are found in ``min_docs`` documents lose all
    their lines but those of the smallest id that holds them. Other lines stay in place.

    Lines are exploded with their place and a 128-bit hash of the key; text leaves its task only
    for the last join, where each document gets the places it loses. For two documents, the
    smallest and the largest id of a key tell whether it repeats: they combine before the shuffle,
    so a line that all documents hold costs one row per task. For other limits the distinct
    (key, id) pairs are counted.

    Defined cases: a null or empty text has one empty line; a null text stays null. Rows with the
    same id are one document, of which each row loses its own lines. A row with a null id keeps
    all its lines and counts for nothing. Columns named n_lines or n_dropped are replaced; others
    may have any name.
    """
    lines = (
        docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
        .select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_row"),
                F.posexplode(F.split(lower_ascii(F.col(text_col)), "\n", -1))
                .alias("_place", "_line"))
        .select("_id", "_row", "_place", F.btrim("_line", F.lit(BLANKS)).alias("_key"))
        .where(F.length("_key") >= min_chars)
        .select("_id", "_row", "_place", F.xxhash64("_key").alias("_h1"),
                F.xxhash64(F.lit("line"), F.col("_key")).alias("_h2")))
    if min_docs <= 2:
        found = lines.groupBy("_h1", "_h2").agg(F.min("_id").alias("_keeper"), F.max("_id").alias("_last"))
        found = found.where(F.col("_keeper") < F.col("_last")) if min_docs == 2 else found
        repeated = staged(found.drop("_last"), "repeated_lines")
    else:
        repeated = staged(
            lines.select("_h1", "_h2", "_id").distinct().groupBy("_h1", "_h2")
            .agg(F.count("*").alias("_docs"), F.min("_id").alias("_keeper"))
            .where(F.col("_docs") >= min_docs).drop("_docs"), "repeated_lines")
    places = (
        lines.join(repeated, ["_h1", "_h2"]).where(F.col("_id") != F.col("_keeper"))
        .groupBy("_id", "_row").agg(F.collect_set("_place").alias("_places")))
    # The lines go through the join instead of the text, so that the split is not repeated
    # for each line that is kept.
    held = docs.select(
        F.struct(*[c for c in docs.columns if c not in ("n_lines", "n_dropped", text_col)])
        .alias("_doc"), F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_row"),
        F.split(text_col, "\n", -1).alias("_lines"))
    joined = held.join(places, ["_id", "_row"], "left")
    n_lines = F.coalesce(F.size("_lines"), F.lit(1))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_places")),
                       lambda i: F.get("_lines", i))
    n_dropped = F.when(F.col("_places").isNull(), 0).otherwise(F.size("_places"))
    text = F.array_join(F.when(F.col("_places").isNull(), F.col("_lines")).otherwise(kept), "\n")
    return joined.select(
        *[text.alias(c) if c == text_col else F.col("_doc").getField(c).alias(c)
          for c in docs.columns if c not in ("n_lines", "n_dropped")],
        F.when(F.col("_lines").isNull(), 1).otherwise(n_lines).cast("long").alias("n_lines"),
        n_dropped.cast("long").alias("n_dropped"))
