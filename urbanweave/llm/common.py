"""What the text operators share: ASCII rules for words, whole-row carriers and joins with group tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanweave.session import stored as stored  # noqa: PLC0414  the operators take it from here

# The white space that separates words, and the only letters that change case.
SPACE = " \t\n\x0b\x0c\r"
SPACES_PATTERN = "[\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: A group table up to this many rows is broadcast; a larger one is joined by shuffle with salted keys.
BROADCAST_ROWS = 20_000
SALTS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    return F.filter(F.split(text, SPACES_PATTERN), lambda w: w != "")


def digest(*values: Column) -> Column:
    """128 bits as a struct of two seeded 64-bit hashes."""
    return F.struct(F.xxhash64(*values).alias("h1"), F.xxhash64(F.lit(7), *values).alias("h2"))


def with_group(rows: DataFrame, groups: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join of many rows with a materialised table that has one row per key.

    A small table is broadcast after counting it. Beyond ``BROADCAST_ROWS`` each key is split over ``SALTS`` copies,
    so a key with a third of all rows is still shared by many tasks.
    """
    if groups.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(groups), keys, how)
    salted = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns if c not in keys]), F.lit(SALTS)).cast("int")
    return rows.withColumn("_salt", salt).join(salted, [*keys, "_salt"], how).drop("_salt")
