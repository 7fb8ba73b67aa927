"""Writers (K1-K5).  Tiles and outputs are keyed: writing a key again replaces it, other keys stay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import uris
from ..operators import blocks as B
from ..operators.pyramid import write_level_store
from .readers import source_bucket


def write_tiles(blocks: DataFrame, out: str) -> None:
    """K1: tile store keyed by (z, x, y, band), partitioned by zoom and quadkey prefix; other stored tiles stay."""
    write_level_store(blocks, out)


def write_source_blocks(blocks: DataFrame, out: str) -> None:
    """Source blocks (block columns, source_id, priority and their grid x0, y0, dx, dy) as the table that
    :func:`readers.read_source_blocks` reads: each with its box, in folders by source, ordered by place so that row
    groups cover small boxes.  Sources written again replace the folders they lie in."""
    size = F.col("size").cast("double")
    west, north = F.col("x0") + F.col("x") * size * F.col("dx"), F.col("y0") - F.col("y") * size * F.col("dy")
    placed = blocks.select(
        *B.BLOCK_COLUMNS, F.col("source_id").cast("long").alias("source_id"), F.col("priority").cast("long").alias("priority"),
        *[F.col(c).cast("double").alias(c) for c in ("x0", "y0", "dx", "dy")], west.alias("west"),
        (north - size * F.col("dy")).alias("south"), (west + size * F.col("dx")).alias("east"), north.alias("north"),
        source_bucket().alias("bucket"))
    (placed.hint("rebalance", "bucket").sortWithinPartitions("bucket", "source_id", "y", "x", "band").write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(out))


def write_converted(df: DataFrame, out: str, key: str = "source_id") -> None:
    """K2: one output per source (partition by the source key), same base name.  Rows are brought
    together by source first; a large source is split over several tasks, small ones share one."""
    (df.hint("rebalance", key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(key).parquet(out))


def write_shade(blocks: DataFrame, out: str) -> None:
    """K3: shade tiles (already cropped, nodata dropped by valid_count)."""
    write_tiles(blocks.where(F.col("valid_count") > 0), out)


RGBA = ("r", "g", "b", "a")


def write_rgba(cells: DataFrame, out: str, size: int, z: int, channels: tuple = RGBA) -> None:
    """K4: a colour-ramped image (a column per channel) as tile blocks, one band per channel (16 bits, -1 where there is no
    pixel), in the keyed tile store."""
    planes = F.explode(F.array(*[F.struct(F.lit(i).alias("band"), F.col(c).cast("double").alias("v")) for i, c in enumerate(channels, start=1)]))
    rows = cells.select("gx", "gy", planes.alias("p")).select("gx", "gy", "p.band", "p.v")
    write_tiles(B.pack_blocks(rows, size, z, dtype="i2", nodata=-1.0, band="band").where(F.col("valid_count") > 0), out)


def conversion_log(sources: DataFrame, ok: str = "ok") -> DataFrame:
    """K5: per source the output URI, NULL when the conversion failed."""
    return sources.select("*", F.when(F.col(ok), uris.target_name("source")).alias("output"))
