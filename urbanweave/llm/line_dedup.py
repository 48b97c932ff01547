"""Removal of lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanweave.llm.common import SPACE, ascii_lower, digest, text_of
from urbanweave.session import cut_lineage


def line_key(line: Column) -> Column:
    """The form in which lines are compared: stripped of ASCII white space at both ends, A-Z lower-cased.

    A line of ASCII alone, nearly every one, takes the built-in rule, which runs over bytes and not over characters.
    """
    bare = F.btrim(line, F.lit(SPACE))
    return F.when(F.octet_length(line) == F.length(line), F.lower(bare)).otherwise(ascii_lower(bare))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1
) -> DataFrame:
    """Drop every line whose key has ``min_chars`` code points or more and occurs in ``min_docs`` documents or more.

    Returns ``row`` (the whole input row as a struct), ``n_lines``, ``n_dropped`` and ``kept`` (the other lines joined
    by newlines, in order). Each row is a document, also if its id is null or repeated; a null text is one empty line;
    an empty table gives an empty one. Other columns stay inside ``row``, so their names cannot clash.

    A line's key is made once and then hashed to 128 bits in plain columns; the documents of a hash are counted with map-side
    combining, so a line of every document costs no more than others. Only positions of dropped lines travel back
    to the documents, which are rebuilt by slicing between those positions: linear in the number of lines.
    """
    base = docs.select(F.struct("*").alias("row"), text_of(text_col).alias("text"), F.col(id_col).alias("id"))
    base = base.select("row", F.split("text", "\n").alias("lines"), digest(F.col("id"), F.col("text")).alias("doc"))
    keys = F.transform("lines", line_key)
    long_enough = F.length("key") >= min_chars

    shared = base.select(F.explode(F.array_distinct(keys)).alias("key")).where(long_enough).select(digest(F.col("key")).alias("line"))
    shared = shared.groupBy("line").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") >= min_docs)
    shared = cut_lineage(shared.select("line"))

    placed = base.select("doc", F.posexplode(keys).alias("at", "key")).where(long_enough)
    placed = placed.select("doc", "at", digest(F.col("key")).alias("line")).join(shared, "line")
    gone = placed.groupBy("doc").agg(F.sort_array(F.collect_set("at")).alias("gone"))

    n = F.size("lines")
    cuts = F.concat(F.array(F.lit(-1)), F.coalesce("gone", F.array().cast("array<int>")), F.array(n))
    runs = F.transform(
        F.sequence(F.lit(0), F.size("cuts") - 2),
        lambda i: F.slice("lines", F.get("cuts", i) + 2, F.get("cuts", i + 1) - F.get("cuts", i) - 1),
    )
    return (
        base.join(gone, "doc", "left")
        .withColumn("cuts", cuts)
        .select(
            "row",
            n.cast("long").alias("n_lines"),
            (F.size("cuts") - 2).cast("long").alias("n_dropped"),
            F.array_join(F.flatten(runs), "\n").alias("kept"),
        )
    )
