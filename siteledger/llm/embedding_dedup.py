"""Near-duplicate vectors by sorted projection passes."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import components, keep, roots_of

# A round is 16 orders by 60 random hyperplanes each; every vector meets its 96 successors in each.
PASSES, BITS, WINDOW = 16, 60, 96
BLOCK = 2048
# Members of a component that are compared in one group when its links are counted.
SIDE = 1024


def _usable(vector: str) -> F.Column:
    numbers = F.col(vector).cast("array<double>")
    finite = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(numbers, lambda x: x != 0), F.lit(False))


def _units(vectors: list[bytes]) -> np.ndarray:
    """Double vectors of equal length as a matrix of unit vectors.

    They are scaled by their largest component first, so that neither huge nor tiny ones lose the sum of squares.
    """
    found = np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1)
    found = found / np.abs(found).max(axis=1, keepdims=True)
    return found / np.sqrt((found * found).sum(axis=1, keepdims=True))


def _packed():
    @F.arrow_udf("binary")
    def packed(vector: pa.Array) -> pa.Array:
        return pa.array([np.array(x, np.float64).tobytes() for x in vector.to_pylist()], pa.binary())
    return packed


def _codes(first: int, passes: int, bits: int):
    """Per vector one sort key for each pass from ``first`` on: the signs of ``bits`` random projections, concatenated."""
    @F.arrow_udf("array<bigint>")
    def codes(vector: pa.Array) -> pa.Array:
        raw = vector.to_pylist()
        out = np.zeros((len(raw), passes), np.int64)
        sizes = np.array([len(x) // 8 for x in raw])
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            unit = _units([raw[i] for i in at])
            for k in range(passes):
                planes = np.random.default_rng([first + k, int(size)]).standard_normal((size, bits))
                out[at, k] = (unit @ planes > 0) @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))
        return pa.array(list(out), pa.list_(pa.int64()))
    return codes


def _groups(by: str, work):
    """mapInArrow function that hands ``work`` each run of equal ``by``; a group may span batches."""
    def run(batches):
        held = None

        def out(rows: pa.Table):
            keys = rows.column(by).to_numpy()
            start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            for a, b in zip(start, np.r_[start[1:], len(keys)], strict=True):
                yield work(rows.slice(a, b - a))

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            keys = held.column(by).to_numpy()
            cut = int(np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])[-1]) if len(keys) else 0
            if cut:
                yield from out(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield from out(held)
    return run


def _neighbours(least: float, window: int, block: int):
    """Links among successors in a block, as a spanning set of its pairs."""
    def work(rows: pa.Table) -> pa.RecordBatch:
        ids, of, place = (rows.column(c).to_numpy() for c in ("id", "series", "place"))
        vectors = rows.column("v").to_pylist()
        sizes = np.array([len(v) for v in vectors])
        left, right = [], []
        # A series has vectors of one length, a block may hold several series.
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            unit = _units([vectors[k] for k in at])
            for step in range(1, min(window, len(at) - 1) + 1):
                near = (unit[:-step] * unit[step:]).sum(axis=1) >= least
                near &= (of[at[:-step]] == of[at[step:]]) & (place[at[:-step]] < block)
                hit = np.flatnonzero(near)
                left.append(ids[at[hit]])
                right.append(ids[at[hit + step]])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
        node, root = roots_of(a, b) if len(a) else (a, b)
        moved = node != root
        return pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(root[moved])], ["a", "b"])
    return work


def _counts(least: float):
    """For each asking vector of a group, the vectors it is linked to, each with its copies."""
    def work(rows: pa.Table) -> pa.RecordBatch:
        ids, asks, copies = (rows.column(c).to_numpy() for c in ("id", "asks", "copies"))
        unit = _units(rows.column("v").to_pylist())
        linked = unit[asks] @ unit[~asks].T >= least
        linked &= ids[asks][:, None] != ids[~asks][None, :]
        return pa.RecordBatch.from_arrays([pa.array(ids[asks]), pa.array(linked @ copies[~asks])], ["id", "n"])
    return work


def _placed(orders: DataFrame, block: int) -> DataFrame:
    """Sort by (series, code, id) over all tasks; block, place in the block and series of each row.

    The sorted rows are written, which fixes their partitions; a row's position is its number there
    plus the sizes of the partitions before.  The sizes are one row for each partition.
    """
    ordered = keep(orders.orderBy("series", "code", "id")
                   .select("series", "id", F.monotonically_increasing_id().alias("m")), "ordered")
    part = F.shiftright("m", 33)
    sizes = ordered.groupBy(part.alias("p")).agg(F.count("*").alias("n"), F.min("m").alias("first"))
    before = F.sum("n").over(Window.orderBy("p")) - F.col("n")
    offsets = sizes.select("p", (before - F.col("first")).alias("shift"))
    at = F.col("m") + F.col("shift")
    return ordered.join(F.broadcast(offsets), part == F.col("p")).select(
        "series", "id", F.floor(at / block).alias("block"), (at % block).alias("place"))


def _round(nodes: DataFrame, number: int, least: float, passes: int, bits: int, window: int, block: int) -> DataFrame:
    """Written links (a, b) that one round of passes finds."""
    coded = nodes.select("id", F.xxhash64("label", F.length("v")).alias("kind"),
                         _codes(number * passes, passes, bits)("v").alias("codes"))
    orders = coded.select("id", F.posexplode("codes").alias("pass", "code"), "kind") \
        .select("id", "code", F.xxhash64("pass", "kind").alias("series"))
    placed = _placed(orders, block)
    tail = placed.where((F.col("place") < window) & (F.col("block") > 0)) \
        .select("series", "id", (F.col("block") - 1).alias("block"), (F.col("place") + block).alias("place"))
    carried = placed.unionAll(tail).join(nodes.select("id", "v"), "id")
    return keep(carried.repartition("block").sortWithinPartitions("block", "place")
                .mapInArrow(_groups("block", _neighbours(least, window, block)), "a bigint, b bigint").distinct(), "links")


def _united(nodes: DataFrame, least: float, passes: int, bits: int, window: int, block: int) -> DataFrame:
    """(id, root) of all nodes with links, from rounds of passes until a round unites nothing that was apart."""
    roots, number = components(_round(nodes, 0, least, passes, bits, window, block)), 0
    while True:
        number += 1
        links = _round(nodes, number, least, passes, bits, window, block)
        named = [roots.withColumnsRenamed({"node": end, "root": f"root_{end}"}) for end in ("a", "b")]
        across = links.join(named[0], "a", "left").join(named[1], "b", "left").select(
            F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")).where("a != b").distinct()
        across = keep(across, "new-links")
        if across.isEmpty():
            return roots.select(F.col("node").alias("id"), "root")
        # Old stars and new links between their roots: one graph, whose nodes were united already for the most part.
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(across))


def link(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
         least: float = 0.93, passes: int = PASSES, bits: int = BITS, window: int = WINDOW,
         block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id for every row.

    Two vectors are linked if their labels are equal and not null and their cosine, in double precision,
    is at least ``least``.

    1. Equal vectors of a label are one node with a number of copies, linked with each other.
    2. In each pass nodes are sorted by label and the concatenated signs of random projections, over all tasks.
       Blocks of the order, with the first ``window`` rows of the next block, compare each row with
       its successors in the window; a block gives out only links that unite rows.
    3. Links of a round of passes are united, and rounds go on with other projections until one unites nothing that was
       apart.  The number of rounds follows the data: where a round finds a pair with probability q, it
       ends with m pairs still apart only with probability (1 - q)**m.
    4. The window bounds what a pass compares, not what is counted: in each component all pairs are
       compared in groups of SIDE by SIDE, which count links and give out no pairs.

    Vectors that are null, empty, zero or hold null or non-finite components, and those with a null label,
    have no links and their own id as component.  Vectors of different lengths are not linked.
    Repeated rows are copies like others; a null id counts as a vector, and a component of null ids alone has a
    null id.  No rows give no rows; other columns are not looked at.  Runs jobs.
    """
    given = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"),
                           F.when(_usable(vector) & F.col(label).isNotNull(),
                                  F.col(vector).cast("array<double>")).alias("v"))
    given = given.withColumn("v", F.when(F.col("v").isNotNull(), _packed()("v")))
    usable = given.where(F.col("v").isNotNull())
    # The length is part of what must be equal, like the label.
    nodes = keep(usable.groupBy("label", "v").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
                 .select(F.monotonically_increasing_id().alias("id"), "label", "v", "vec_id", "copies"), "nodes")
    roots = _united(nodes, least, passes, bits, window, block)
    groups = keep(roots.unionAll(roots.select("root", "root").distinct()), "roots")
    sizes = groups.groupBy("root").agg(F.ceil(F.count("*") / SIDE).cast("int").alias("sides"))
    members = groups.join(sizes, "root").join(nodes.select("id", "v", "copies"), "id") \
        .withColumn("side", F.pmod(F.xxhash64("id"), F.col("sides")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
    both = [members.select(F.xxhash64("root", *pair).alias("g"), F.lit(asks).alias("asks"), "id", "v", "copies")
            for asks, pair in ((True, ("side", "other")), (False, ("other", "side")))]
    counted = reduce(DataFrame.unionAll, both).repartition("g").sortWithinPartitions("g") \
        .mapInArrow(_groups("g", _counts(least)), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    whole = nodes.select("id", "label", "v", "vec_id", "copies").join(groups, "id", "left") \
        .withColumn("root", F.coalesce("root", "id")).join(counted, "id", "left")
    first = whole.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    answer = keep(whole.join(first, "root").select(
        "label", "v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "answer")
    linked = usable.join(answer, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = given.where(F.col("v").isNull()).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone)
