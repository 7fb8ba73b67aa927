"""Keys that may be hot (one source or tile holding a large share of all rows): measured, then split.

How many salts a key gets comes from the data: rows are counted per key, and a key with more than
``share`` rows is dealt over so many salts that none holds more than about ``share``.  Only such keys are listed, and
``share`` is at least the HOT_KEYS-th part of all rows, so the list that joins the rows is bounded (HOT_KEYS rows) and
may be broadcast; every other key keeps one salt and costs nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHARE_ROWS = 1 << 20         # rows of one (key, salt) group aimed at
HOT_KEYS = 20_000            # keys that can hold more than the HOT_KEYS-th part of all rows
HASHES = 1 << 15             # rows are counted by this many hashes of the key first: more than HOT_KEYS


def found_hot(rows: DataFrame, on: list[str], share: int = SHARE_ROWS) -> DataFrame | None:
    """(keys, _salts): the keys that hold more than ``share`` rows, at most HOT_KEYS of them, and how many salts each
    needs.  None if there are none.

    Rows are counted by a hash of the key, which gives the driver two numbers: all rows, and those of the fullest hash.
    Keys are counted only where their hash holds more than ``share`` rows, so that many small keys cost no aggregate.
    """
    hashed = rows.select(*on, F.pmod(F.xxhash64(*on), F.lit(HASHES)).alias("_hash"))
    by_hash = hashed.groupBy("_hash").agg(F.count("*").alias("_rows"))
    total, fullest = by_hash.agg(F.sum("_rows"), F.max("_rows")).first()
    share = max(share, -(-(total or 0) // HOT_KEYS))
    if (fullest or 0) <= share:
        return None
    full = by_hash.where(F.col("_rows") > share).select("_hash")                   # HOT_KEYS rows at most
    counts = hashed.join(F.broadcast(full), "_hash", "left_semi").groupBy(*on).agg(F.count("*").alias("_rows"))
    return counts.where(F.col("_rows") > share).select(*on, F.ceil(F.col("_rows") / share).cast("int").alias("_salts"))


def hot_keys(rows: DataFrame, on: list[str], share: int = SHARE_ROWS) -> DataFrame:
    """:func:`found_hot`, with no rows if there are none."""
    found = found_hot(rows, on, share)
    if found is not None:
        return found
    return rows.sparkSession.createDataFrame([], T.StructType([*[rows.schema[c] for c in on], T.StructField("_salts", T.IntegerType())]))


def salted(rows: DataFrame, on: list[str], salt_from: tuple, share: int = SHARE_ROWS, hot: DataFrame | None = None) -> DataFrame:
    """``rows`` with a ``_salt`` (0 for keys that are not hot), taken from a hash of the ``salt_from`` columns, so that
    a repeated task gives a row the same salt."""
    met = with_salts(rows, on, hot_keys(rows, on, share) if hot is None else hot)
    return met.withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(*salt_from), F.col("_salts")), F.lit(0)).cast("int")).drop("_salts")


def with_salts(rows: DataFrame, on: list[str], hot: DataFrame) -> DataFrame:
    """``rows`` with the ``_salts`` of their key, null if it is not hot."""
    named = hot.select(*[F.col(c).alias(f"_hot_{c}") for c in on], "_salts")
    met = rows.join(F.broadcast(named), [rows[c].eqNullSafe(named[f"_hot_{c}"]) for c in on], "left")       # HOT_KEYS rows at most
    return met.drop(*[f"_hot_{c}" for c in on])


def salted_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
                salt_from: tuple[str, ...] = ("gx", "gy"), share: int = SHARE_ROWS) -> DataFrame:
    """Join ``big`` (many rows per key, e.g. pixels per source) to ``small`` (about one row per
    key, e.g. per-source metadata or a work list).

    A key that is hot in ``big`` is dealt over as many salts as its rows need, and only its rows of ``small`` are
    repeated, once per salt; the join runs on (key, salt).  ``how`` is ``inner`` or ``left_semi``.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError(how)
    hot = hot_keys(big, on, share)
    b = salted(big, on, salt_from, share, hot)
    s = small.join(F.broadcast(hot), on, "left")
    s = s.select(*[c for c in s.columns if c != "_salts"], F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)).alias("_salt"))
    return b.join(s, [*on, "_salt"], how).drop("_salt")
