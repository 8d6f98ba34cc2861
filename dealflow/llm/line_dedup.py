"""Line deduplication across documents, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealflow.llm.common import MAX_ID, WS, cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased. ``lower`` is exact for
    ASCII lines; only others pay for ``translate``."""
    bare = F.btrim(line, F.lit(WS))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = 10, carry: list[str] | None = None) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept) for every row of ``docs``, or the columns ``carry``
    instead of the id.

    Lines are exploded and normalised, their keys hashed to 128 bits, and each hash gets the
    smallest and the largest document that holds it (an aggregate with partial combine, so a
    line that every document holds is no hot group). Where the two differ, the line goes from
    all documents but the smallest. Those first-holder rows are written as a table: the join
    of the lines back to it then has a plain exchange on either side, which adaptive execution
    can split at a hot line. Only hashes and positions are shuffled for the decision; texts
    move once, to meet the positions that they lose.

    A null or empty text is one empty line. Keys shorter than ``min_chars`` code points are
    never dropped. Rows with a null id count as one document that comes after all others.
    Rows that repeat an id count as one document, and each loses the same lines; positions are
    kept once for each (id, text), however many rows repeat it. Other
    columns of ``docs``, whatever their names, are not looked at. No rows give no rows.
    """
    base = docs.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(MAX_ID)).alias("__id"),
                       F.struct(*[F.col(f"`{c}`") for c in carry or [doc_id]]).alias("__own"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    base = base.withColumn("__version", F.xxhash64("__text")).withColumn("__lines", F.split("__text", "\n", -1))
    at = base.select("__id", "__version", F.posexplode("__lines").alias("pos", "line"))
    at = at.withColumn("key", line_key(F.col("line"))).where(F.length("key") >= min_chars)
    at = at.select("__id", "__version", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"))
    first = cut(at.groupBy("h1", "h2").agg(F.min("__id").alias("first"), F.max("__id").alias("last"))
                .where("first < last").select("h1", "h2", "first"), "first-lines")
    gone = (at.join(first, ["h1", "h2"]).where("__id <> first")
            .groupBy("__id", "__version").agg(F.collect_set("pos").alias("gone")))
    n = F.size("__lines")
    stay = F.array_except(F.sequence(F.lit(0), n - 1), F.col("gone"))
    lines = F.col("__lines")
    return (base.drop("__text").join(gone, ["__id", "__version"], "left")
            .withColumn("__stay", F.when(F.col("gone").isNotNull(), stay))
            .select("__own.*", n.cast("bigint").alias("n_lines"),
                    F.when(F.col("__stay").isNull(), 0).otherwise(n - F.size("__stay")).cast("bigint").alias("n_dropped"),
                    F.when(F.col("__stay").isNull(), F.array_join(lines, "\n"))
                    .otherwise(F.array_join(F.transform("__stay", lambda p: lines[p]), "\n")).alias("kept")))
