"""Near-duplicate documents by SuperMinHash signatures, banding, full verification and union-find."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .bloom import listed_or_not
from .common import components, keep
from .textnum import GOLDEN, LOWER, U64, chunks, column_bytes, distinct, mix, sequence_keys, shingles, \
    times, word_hashes, words
from .workers import free

# 40 bands of 6: a pair at similarity 0.8 shares no band with probability 5e-6, one at 0.5
# shares one with probability 0.47, one at 0.3 with 0.03.
BANDS, ROWS_PER_BAND = 40, 6
UNSET = U64(0xFFFFFFFFFFFFFFFF)
# Members of a bucket that are compared in one group, and the share of equal slots below which a pair
# can't reach the similarity: 0.13 under it, five standard deviations of the estimate at 0.8.
BLOCK = 1024
MARGIN = 0.13


def superminhash(values: np.ndarray, row: np.ndarray, n_rows: int, size: int, seed: int = 1) -> np.ndarray:
    """Signatures (n_rows, size) of sets given as distinct values with their row.

    Each element draws a random permutation of the slots one step at a time; in step j it
    offers j + r (0 <= r < 1) to the j-th slot of its permutation, and each slot keeps the least
    offer.  All elements of all rows take a step together.  As offers of a later step are always
    larger, a row stops once every slot is filled: no later step can change it.  Slots
    hold j in the upper 16 bits and r in the lower 48.  Rows without elements stay UNSET.
    """
    least = np.full(n_rows * size, UNSET)
    base = row.astype(np.int64) * size
    values = values + times(seed, GOLDEN)
    places = np.tile(np.arange(size, dtype=np.uint16 if size > 256 else np.uint8), (len(values), 1))
    for step in range(size):
        if not len(values):
            break
        random = mix(values ^ times(step + 1, GOLDEN))
        pick = step + (((random & U64(0xFFFF)) * U64(size - step)) >> U64(16)).astype(np.int64)
        element = np.arange(len(values))
        slot = places[element, pick]
        places[element, pick] = places[:, step]
        at = base + slot
        open_ = least[at] == UNSET
        at = at[open_]
        np.minimum.at(least, at, (U64(step) << U64(48)) | (random[open_] >> U64(16)))
        full = (least.reshape(n_rows, size) != UNSET).all(axis=1)
        active = ~np.repeat(full, size)[base]
        if not active.all():
            values, base, places = values[active], base[active], places[active]
    return least.reshape(n_rows, size)


def short(signature: np.ndarray) -> np.ndarray:
    """8 bits of each slot: unequal slots agree once in 256, and signatures take an eighth of the space."""
    return mix(signature).astype(np.uint8)


def bands_of(slots: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band, the band's number mixed in."""
    out = np.zeros((len(slots), bands), U64)
    parts = slots.astype(U64).reshape(-1, bands, rows)
    for k in range(rows):
        out = out * GOLDEN + mix(parts[:, :, k] + U64(k))
    return mix(out + np.arange(bands, dtype=U64) * GOLDEN).astype(np.int64)


def _sets(column: pa.Array, width: int) -> Iterator[tuple]:
    """For ranges of rows: their number, sequence keys, distinct shingles and the rows of these."""
    data, offsets = column_bytes(column)
    for a, b in chunks(offsets, 1 << 19):
        text = LOWER[data[offsets[a]:offsets[b]]]
        start, end, row = words(text, offsets[a:b + 1] - offsets[a])
        hashes = word_hashes(text, start, end)
        value, of, _ = shingles(hashes, row, width)
        yield (b - a, sequence_keys(hashes, row, b - a), *distinct(value, of))


def _signatures(width: int, slots: int):
    def run(batches):
        free()
        for batch in batches:
            keys, counts, made = [], [np.zeros(0, np.int64)], []
            for n, key, value, of in _sets(batch.column("text"), width):
                keys += key
                counts.append(np.bincount(of, minlength=n))
                made += map(np.ndarray.tobytes, short(superminhash(value, of, n, slots)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("th"), pa.array(keys, pa.binary()),
                 pa.array(np.frombuffer(b"".join(keys), np.int64)[::2]),
                 pa.array(np.concatenate(counts), pa.int64()), pa.array(made, pa.binary())],
                names=["doc_id", "th", "key", "id", "n", "slots"])
    return run


def _bands(bands: int, rows: int):
    @F.arrow_udf("array<bigint>")
    def keys(slots: pa.Array) -> pa.Array:
        made = np.frombuffer(b"".join(slots.to_pylist()), np.uint8).reshape(-1, bands * rows)
        return pa.array(list(bands_of(made, bands, rows)), pa.list_(pa.int64()))
    return keys


def _full_sets(width: int):
    @F.arrow_udf("struct<key: binary, items: binary>")
    def full_set(text: pa.Array) -> pa.Array:
        keys, items = [], []
        for n, key, value, of in _sets(text, width):
            keys += key
            ends = np.searchsorted(of, np.arange(n + 1))
            items += [value[ends[i]:ends[i + 1]].tobytes() for i in range(n)]
        return pa.StructArray.from_arrays([pa.array(keys, pa.binary()), pa.array(items, pa.binary())],
                                          names=["key", "items"])
    return full_set


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct values."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def _linked(percent: int):
    @F.arrow_udf("boolean")
    def linked(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(left, right, strict=True):
            a, b = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
            both = _common(a, b)
            out.append(100 * both >= percent * (len(a) + len(b) - both))
        return pa.array(out, pa.bool_())
    return linked


def _alike(percent: int, slots: int):
    @F.arrow_udf("boolean")
    def alike(left: pa.Array, right: pa.Array) -> pa.Array:
        a, b = (np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(-1, slots) for x in (left, right))
        return pa.array((a == b).sum(axis=1) >= (percent / 100 - MARGIN) * slots)
    return alike


def _halves():
    """Sets with 32 bits of each value, sorted: for a first comparison at half the volume."""
    @F.arrow_udf("binary")
    def halves(items: pa.Array) -> pa.Array:
        return pa.array([np.sort(np.frombuffer(x.as_buffer(), U64).astype(np.uint32)).tobytes() for x in items],
                        pa.binary())
    return halves


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 4,
               slots: int = BANDS * ROWS_PER_BAND) -> DataFrame:
    """doc_id, th (hash of id and text), key (128 bits of the word sequence), id (64 of these), n (set size),
    slots (8 bits each)."""
    kind = docs.select(F.col(doc_id).alias("doc_id")).schema["doc_id"].dataType.simpleString()
    given = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(doc_id, text).alias("th"),
                        F.col(text).alias("text"))
    return given.mapInArrow(_signatures(width, slots),
                            f"doc_id {kind}, th bigint, key binary, id bigint, n bigint, slots binary")


def _shared_buckets(buckets: DataFrame) -> DataFrame:
    """Rows of the buckets with two or more members, with the bucket's hub: its member of least id,
    a random one.  Only these rows are looked at from here on.

    Spark sizes the buckets by the nodes' file, as if a list of bands were one band, and would broadcast them: they are merged.
    """
    hubs = buckets.groupBy("bucket").agg(F.min("id").alias("hub"), F.count("*").alias("m")) \
        .where("m > 1").select("bucket", "hub")
    return buckets.join(hubs.hint("merge"), "bucket")


def _sets_of(shared: DataFrame, nodes: DataFrame, docs: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """id, key and full set of the nodes in shared buckets; a Bloom filter lets hardly any other text be shuffled."""
    named = keep(nodes.join(shared.select("id").distinct(), "id", "left_semi").select("id", "key", "th"), "named")
    given = docs.select(F.xxhash64(doc_id, text).alias("th"), F.col(text).alias("text"))
    maybe, _ = listed_or_not(given, "th", named)
    made = maybe.join(named, "th").dropDuplicates(["th", "key"]) \
        .select("id", "key", _full_sets(width)("text").alias("made"))
    # A text is found by a 64-bit hash; its 128-bit key says that it is the right one.
    return made.where(F.col("key") == F.col("made.key")).select("id", "key", F.col("made.items").alias("items"))


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Keys (a, b) of the linked pairs among candidate pairs of ids, by the full sets."""
    left = sets.select(F.col("id").alias("a_id"), F.col("key").alias("a"), F.col("items").alias("a_items"))
    right = sets.select(F.col("id").alias("b_id"), F.col("key").alias("b"), F.col("items").alias("b_items"))
    met = pairs.join(left, "a_id").join(right, "b_id")
    return met.where(_linked(percent)("a_items", "b_items")).select("a", "b")


def _hub_pairs(shared: DataFrame, nodes: DataFrame, percent: int, slots: int) -> DataFrame:
    """Members with their bucket's hub, if sizes and signatures allow a link: as many as members at most."""
    pairs = shared.where("id != hub").select(F.col("hub").alias("a_id"), F.col("id").alias("b_id")).distinct()
    marks = nodes.select("id", "n", "slots")
    met = pairs.join(marks.withColumnsRenamed({"id": "a_id", "n": "a_n", "slots": "a_slots"}), "a_id") \
        .join(marks.withColumnsRenamed({"id": "b_id", "n": "b_n", "slots": "b_slots"}), "b_id")
    return met.where(100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")) \
        .where(_alike(percent, slots)("a_slots", "b_slots")).select("a_id", "b_id")


def _open_buckets(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """Members, without the hub, of the buckets where these are not all of one component yet, with their
    component, whether it is the bucket's largest (``main``), and the numbers of all and other members."""
    rooted = shared.where("id != hub").select("bucket", "id").join(roots, "id", "left") \
        .withColumn("root", F.coalesce("root", "id"))
    split = rooted.groupBy("bucket", "root").agg(F.count("*").alias("n_root")).groupBy("bucket").agg(
        F.max(F.struct("n_root", "root")).alias("top"), F.sum("n_root").alias("members")) \
        .where("members > top.n_root")
    return rooted.join(split, "bucket").select(
        "bucket", "id", "root", (F.col("root") == F.col("top.root")).alias("main"), "members",
        (F.col("members") - F.col("top.n_root")).alias("minor"))


def _join_components(percent: int, bands: int, rows: int):
    """Pairs that link different components of a group: at most one for each component that is joined.

    The asking members meet the others one after the other.  A pair is compared in the first
    band that it shares, by signature and then by its sets of 32-bit values; what is linked is united at once, so
    that members of one component are not compared any more.
    """
    size = bands * rows
    enough = (percent / 100 - MARGIN) * size

    def pairs(group: pa.Table) -> tuple[list, list]:
        slots = np.frombuffer(b"".join(group.column("slots").to_pylist()), np.uint8).reshape(-1, size)
        keys = bands_of(slots, bands, rows)
        items = [np.frombuffer(x, np.uint32) for x in group.column("items").to_pylist()]
        n = np.array([len(x) for x in items])
        asks, ids, root, bucket = (group.column(c).to_numpy() for c in ("asks", "id", "root", "bucket"))
        root = root.copy()
        start = np.flatnonzero(np.r_[True, np.diff(group.column("g").to_numpy()) != 0])
        left, right = [], []
        for a, b in zip(start, np.r_[start[1:], len(n)], strict=True):
            those = a + np.flatnonzero(~asks[a:b])
            for one in a + np.flatnonzero(asks[a:b]):
                close = 100 * np.minimum(n[those], n[one]) >= percent * np.maximum(n[those], n[one])
                others = those[close & (root[those] != root[one])]
                others = others[(slots[others] == slots[one]).sum(axis=1) >= enough]
                for other in others:
                    if root[other] == root[one] or keys[one, np.argmax(keys[one] == keys[other])] != bucket[one]:
                        continue
                    both = _common(items[one], items[other])
                    if 100 * both >= percent * (n[one] + n[other] - both):
                        left.append(ids[one])
                        right.append(ids[other])
                        root[a:b][root[a:b] == root[other]] = root[one]
        return left, right

    def run(batches):
        held = None

        def out(rows: pa.Table) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in pairs(rows)], ["a_id", "b_id"])

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            groups = held.column("g").to_numpy()
            cut = int(np.searchsorted(groups, groups[-1])) if len(groups) else 0
            if cut:
                yield out(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield out(held)
    return run


def _other_pairs(opened: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int, bands: int, rows: int) -> DataFrame:
    """Candidate links between components in open buckets.

    In each bucket the members outside its main component meet all members, in groups of at
    most BLOCK by BLOCK: a large bucket makes more groups, not larger ones, and a group gives out
    only what joins components, never a list of its pairs.
    """
    def blocks(count: str):
        return F.ceil(F.col(count) / BLOCK).cast("int")

    def block(count: str):
        return F.pmod(F.xxhash64("id"), blocks(count)).cast("int")

    carried = nodes.select("id", "slots").join(sets.select("id", _halves()("items").alias("items")), "id")
    asking = opened.where(~F.col("main")).withColumn("i", block("minor")) \
        .withColumn("j", F.explode(F.sequence(F.lit(0), blocks("members") - 1)))
    asked = opened.withColumn("j", block("members")) \
        .withColumn("i", F.explode(F.sequence(F.lit(0), blocks("minor") - 1)))
    columns = ["id", "root", "bucket", F.xxhash64("bucket", "i", "j").alias("g")]
    both = asking.select(F.lit(True).alias("asks"), *columns).unionAll(asked.select(F.lit(False).alias("asks"), *columns))
    # A member goes to all blocks of the other side, which Spark's size of the members leaves out.
    placed = both.join(carried.hint("merge"), "id").repartition("g").sortWithinPartitions("g")
    return placed.mapInArrow(_join_components(percent, bands, rows), "a_id bigint, b_id bigint").distinct()


def _rooted(docs: DataFrame, doc_id: str, text: str, width: int, percent: int, bands: int, rows: int
            ) -> tuple[DataFrame, DataFrame]:
    """Rows with words (doc_id, th, n, root), equal in root if of one component; and the rows without words."""
    slots = bands * rows
    made = keep(signatures(docs, doc_id, text, width, slots), "signatures")
    full = made.where("n > 0")
    nodes = keep(full.groupBy("key").agg(F.min(F.struct("doc_id", "th")).alias("rep"), F.first("id").alias("id"),
                                         F.first("n").alias("n"), F.first("slots").alias("slots"))
                 .select("key", F.col("rep.th").alias("th"), "id", "n", "slots"), "nodes")
    buckets = nodes.select(F.explode(_bands(bands, rows)("slots")).alias("bucket"), "id")
    shared = keep(_shared_buckets(buckets), "shared-buckets")
    sets = keep(_sets_of(shared, nodes, docs, doc_id, text, width), "sets")
    links = keep(_verify(keep(_hub_pairs(shared, nodes, percent, slots), "hub-pairs"), sets, percent), "hub-links")
    by_id = nodes.select("key", "id")
    roots = components(links).join(by_id.withColumnRenamed("key", "node"), "node") \
        .join(by_id.select(F.col("key").alias("root"), F.col("id").alias("root_id")), "root")
    opened = keep(_open_buckets(shared, roots.select("id", F.col("root_id").alias("root"))), "open-buckets")
    others = keep(_other_pairs(opened, nodes, sets, percent, bands, rows), "other-pairs")
    roots = components(links.union(_verify(others, sets, percent)))
    members = full.select("doc_id", "th", "n", "key").join(roots.select(F.col("node").alias("key"), "root"), "key", "left") \
        .withColumn("root", F.coalesce("root", "key"))
    return members, made.where("n = 0")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 4,
            percent: int = 80, bands: int = BANDS, rows: int = ROWS_PER_BAND) -> DataFrame:
    """doc_id, n_shingles, component_id for every row; linked documents share component_id.

    Words are lower-cased (A-Z) runs of bytes other than ASCII white space; a document's set
    holds its distinct ``width``-word shingles, or its whole sequence if it has fewer words.  Links
    are pairs with 100 * |A and B| >= percent * |A or B|; component_id is the smallest id reachable.

    1. Documents of equal word sequences are one node, so copies are never compared.
    2. Nodes with an equal band share a bucket, and each bucket's members are verified against
       one hub: as many pairs as members.  Union-find joins the links; a group of near copies
       mostly falls into one component that way, however large it is.
    3. Buckets whose members still lie in several components go on: all their pairs that could
       join components are compared by signature, and the close ones verified, so no link of a
       bucket is lost to the choice of the hub.

    Documents without words or with null text have n_shingles 0 and are linked with nothing.
    Rows with a null id are nodes like others; a component of null ids alone has a null
    component_id.  Repeated rows appear each.  No rows give no rows; other columns are not
    looked at.  Runs jobs; steps are written to the shared folder.
    """
    members, bare = _rooted(docs, doc_id, text, width, percent, bands, rows)
    least = members.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    linked = members.join(least, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    empty = bare.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionAll(empty)


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5,
                     percent: int = 80) -> DataFrame:
    """One document of each component stays, with all its columns: that of the smallest id.

    A document is a row's id and text: a repeated id loses only the texts that are near copies, of which the
    one of smallest hash stays if they share the smallest id.  A null id comes after all others.  Rows
    repeated with the same id and text are one document, and stay or go together.  Documents without words stay.
    """
    members, _ = _rooted(docs, doc_id, text, width, percent, BANDS, ROWS_PER_BAND)
    first = members.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("first")).select("root", "first.th")
    losers = members.join(first.withColumnRenamed("th", "stays"), "root").where("th != stays") \
        .select("th", F.col("doc_id").alias("lost")).distinct()
    rows = docs.select(F.xxhash64(doc_id, text).alias("th"), F.col(doc_id).alias("own_id"), F.struct("*").alias("row"))
    losers = keep(losers, "losers")
    maybe, sure = listed_or_not(rows, "th", losers)
    lost = (maybe["th"] == losers["th"]) & F.col("own_id").eqNullSafe(F.col("lost"))
    return sure.unionAll(maybe.join(losers, lost, "left_anti")).select("row.*")
