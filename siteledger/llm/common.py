"""What several operators share: tables, written intermediates, components of a link graph."""

from __future__ import annotations

import gc
import os
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.landing import pin


# Rows of an Arrow batch where the session leaves Spark's 10,000: rows are whole texts or sets here, and a
# worker and the JVM each hold several batches.
BATCH_ROWS, BATCH_SETTING = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"


# Workers live on beside the JVM: what they free should go back to the system, not into pools of their own.
WORKER_SETTINGS = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "1", "MALLOC_TRIM_THRESHOLD_": "1048576",
                   "MALLOC_MMAP_THRESHOLD_": "1048576", "OPENBLAS_NUM_THREADS": "1"}


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches, and let Python workers find this package where it lies on a shared path only."""
    if spark.conf.get(BATCH_SETTING, "10000") == "10000":
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    for name, value in WORKER_SETTINGS.items():
        env.setdefault(name, value)
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage, runs a job."""
    return pin(df, label)[0]


def release(*frames: DataFrame) -> None:
    """Delete written intermediates that no frame to come reads, and let Spark drop the shuffles behind them.

    For steps of a long operator: what is given must come from ``keep`` as it is, and all that reads it must be written.
    """
    for frame in frames:
        context = frame.sparkSession.sparkContext
        for folder in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    # Shuffle files go when the driver's JVM finds that nothing refers to them any more.
    gc.collect()
    context._jvm.System.gc()


def roots_of(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union-find over edges given as two arrays: each node with the smallest node of its set."""
    nodes, index = np.unique(np.concatenate([first, second]), return_inverse=True)
    parent = list(range(len(nodes)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    half = len(first)
    for a, b in zip(index[:half].tolist(), index[half:].tolist(), strict=True):
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return nodes, nodes[[find(i) for i in range(len(nodes))]]


def _forest(batches):
    """Replace each batch of edges by a star per set; linear output, bounded by the batch."""
    for edges in batches:
        a, b = (np.array(edges.column(c).to_pylist(), dtype=object) for c in ("a", "b"))
        nodes, roots = roots_of(a, b)
        moved = nodes != roots
        kind = edges.schema.field("a").type
        yield pa.RecordBatch.from_arrays([pa.array(x[moved].tolist(), kind) for x in (nodes, roots)], ["a", "b"])


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step: only per-node minima and joins, so a node
    with any number of links is an ordinary skewed join and no neighbour list is gathered."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.min("b").alias("m")) \
        .select("a", F.least("a", "m").alias("m"))
    large = both.where(F.col("b") > F.col("a")).join(least, "a") \
        .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    large = keep(large.where(F.col("a") != F.col("b")), "large-star")
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(low, "a").where(F.col("b") != F.col("m")) \
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
    return keep(small.union(low.select("a", F.col("m").alias("b"))).distinct(), "small-star")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links (a, b): rows (node, root), root the smallest node reachable.

    Tasks first shrink their own edges by union-find; then large-star and small-star
    steps run until nothing changes (a number of rounds logarithmic in practice).  Null ends
    and self links are ignored, repeated links count once, no links give no rows.
    Runs jobs; every step is written to the shared folder.
    """
    kind = edges.schema["a"].dataType.simpleString()
    clean = edges.select("a", "b").where(F.col("a").isNotNull() & F.col("b").isNotNull()
                                         & (F.col("a") != F.col("b")))
    current = keep(clean.mapInArrow(_forest, f"a {kind}, b {kind}"), "forest")
    seen = None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen or not state[0]:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = tuple(state)
        current = _stars(current)
