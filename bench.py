"""Benchmark of the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS], materialising the full result with the no-op sink (so
nothing is collected to the driver), and prints ONE JSON line with the
seconds per query.  Shuffle bytes written and input records per query come
from Spark's event log (written to a fresh scratch folder; no UI involved).
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import numpy as np  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tessera.functions import grid  # noqa: E402
from tessera.operators import blocks as B, reproject as RP, windows as WN  # noqa: E402
from tessera.plans import jobs as J  # noqa: E402
from tessera.queries import QUERIES  # noqa: E402
from tessera.session import get_session, scratch_path  # noqa: E402
from tessera.sources import fixtures as FX, readers as RD, sinks as SK  # noqa: E402

# block-form queries and their cell-form twins are both timed (same results, same oracle)
HEADLINE = ["pyramid_levels", "pyramid_levels_cells", "pyramid_average", "pyramid_average_cells",
            "mosaic_paint", "chunk_average", "chunk_tiles", "warp_bilinear", "warp_bilinear_blocks",
            "hillshade_light", "shade_halo", "hillshade_zfactor", "missing_targets", "dem_blocks_valid",
            "window_read", "warp_bands", "gradient", "source_overlap", "reblock", "warp_4326",
            "warp_4326_blocks"]


def _event_metrics(log_dir: str) -> dict:
    """Per job group: shuffle bytes written, input records read, tasks."""
    stage_group: dict[int, str] = {}
    out: dict[str, dict] = defaultdict(lambda: {"shuffle_bytes": 0, "input_records": 0, "tasks": 0})
    paths = sorted(p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
                   if os.path.isfile(p) and not p.endswith(".crc") and "appstatus" not in os.path.basename(p))
    for path in paths:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = g
                elif kind == "SparkListenerTaskEnd":
                    g = stage_group.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    if g is None:
                        continue
                    out[g]["tasks"] += 1
                    out[g]["shuffle_bytes"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    out[g]["input_records"] += (m.get("Input Metrics") or {}).get("Records Read", 0)
    return dict(out)


BIG, BIG_ZOOM = 2048, 6      # production tiles: 2048 x 2048 float32, 16 MB


def big_tiles(spark, sf_dir: str) -> str:
    """A store of production tiles: the first four rows of dem tiles, every pixel repeated 64 x 64 times (4 x 4 tiles)."""
    small = B.pack_blocks(FX.dem_dense(spark, sf_dir), FX.TILE, BIG_ZOOM, dtype="f4", nodata=FX.NODATA).where("y < 4 and valid_count > 0")

    def enlarge(batches):
        k = BIG // FX.TILE
        for rb in batches:
            for r in rb.to_pylist():
                v = np.kron(B.row_values(r), np.ones((k, k))) + np.linspace(0, 1, BIG)[None, :]
                arr, valid = B.from_float(v, "f4", FX.NODATA)
                yield from B.records_to_table([B.block_record(r["z"], r["x"], r["y"], 1, BIG, "f4", FX.NODATA, arr, valid)]).to_batches()

    store = scratch_path(spark, "bench-big")
    SK.write_tiles(small.repartition(16, "x", "y").mapInArrow(enlarge, B.BLOCK_SCHEMA), store)
    return store


def big_jobs(spark, sf_dir: str) -> dict:
    """Z1, Z2 and Z6 on production tiles: seconds, tiles written and MB of input a second."""
    store, out = big_tiles(spark, sf_dir), {}
    tiles = RD.read_tiles(spark, store, z=BIG_ZOOM)
    n = tiles.count()
    px = grid.WORLD / 2 ** BIG_ZOOM / BIG
    src = RP.Grid("EPSG:3857", -grid.HALF_WORLD, grid.HALF_WORLD, px, px)
    one = tiles.select("*", F.lit(1).alias("priority"), F.lit(1).alias("source_id"))
    parents = tiles.select(F.lit(BIG_ZOOM - 1).alias("z"), *[F.floor(F.col(c) / 2).cast("int").alias(c) for c in ("x", "y")]).distinct()
    runs = {
        "chunk": lambda: J.chunk_reproject(spark, one, src, BIG_ZOOM - 1, BIG, scratch_path(spark, "bench-chunk"), dtype="f4", nodata=FX.NODATA).count(),
        "pyramid": lambda: J.pyramid(spark, store, BIG_ZOOM).where(F.col("z") < BIG_ZOOM).count(),
        "shade_window": lambda: SK.write_shade(WN.shade_windows(tiles, parents, BIG_ZOOM, BIG, BIG, "zfactor", pixel=(px, px)),
                                               path := scratch_path(spark, "bench-shade")) or RD.read_tiles(spark, path).count(),
    }
    for name, run in runs.items():
        spark.sparkContext.setJobGroup(f"big_{name}", name)
        t0 = time.time()
        made = run()
        sec = time.time() - t0
        out[name] = {"sec": round(sec, 3), "tiles_in": n, "tiles_out": made, "mb_in_per_s": round(n * BIG * BIG * 4 / 1e6 / sec, 1)}
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    log_dir = tempfile.mkdtemp(prefix="run-bench-events-", dir=os.environ.get("BENCH_SCRATCH", "/tmp"))
    spark = get_session(f"local[{cpus}]", app="tessera-bench", **{
        "spark.sql.shuffle.partitions": str(max(2 * cpus, 8)),
        "spark.driver.memory": "16g",
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": "file://" + log_dir,
        "spark.eventLog.compress": "false",
    })
    sc = spark.sparkContext
    # warm-up: JVM, Arrow Python workers, parquet footers, the tile store
    sc.setJobGroup("warmup", "warmup")
    for w in ("decimate", "dem_blocks_valid", "warp_nearest_blocks", "pyramid_manifest"):   # scans, mapInArrow, grouped Arrow, writes
        QUERIES[w](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        sc.setJobGroup(name, name)
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    big = {} if sys.argv[1:] else big_jobs(spark, sf_dir)
    spark.stop()
    metrics = _event_metrics(log_dir)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf_dir, "cpus": cpus,
        "shuffle_bytes": {n: metrics.get(n, {}).get("shuffle_bytes", 0) for n in names},
        "input_records": {n: metrics.get(n, {}).get("input_records", 0) for n in names},
        "tasks": {n: metrics.get(n, {}).get("tasks", 0) for n in names},
        "tiles_2048_f4": big,
    }))


if __name__ == "__main__":
    main()
