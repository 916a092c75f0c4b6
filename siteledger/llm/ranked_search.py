"""Ranked lexical search: an inverted index in shards of compressed blocks, searched by Block-Max MaxScore."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import keep
from .textnum import LOWER, chunks, column_bytes, word_hashes, words

# The terms and the weights of the score.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER_CASE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SCALE, SATURATION, LENGTH_PERCENT = 1_000_000_000, 8, 90
NO_TERM = np.ones(256, bool)
NO_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

BLOCK = 128
# A shard ends with the piece of texts (1 MB, or one longer text) that reaches one of these.
SHARD_TERMS, SHARD_DOCS = 1_000_000, 1 << 15
# Terms of the queries that one pass over the index takes: bounds the driver and what is sent to the tasks.
QUERY_TERMS = 1 << 17
TOP = 10
INDEX = "shard long, term string, df long, total long, heads binary, body binary"
OUT = pa.schema([("shard", pa.int64()), ("term", pa.string()), ("df", pa.int64()), ("total", pa.int64()),
                 ("heads", pa.binary()), ("body", pa.binary())])
# One row for each block: its last document, where it begins in the body, its documents and the bytes of a gap and
# of a count.  The block's best pairs of count and length follow, in a list of their own.
HEAD = np.dtype([("last", "<u4"), ("at", "<u4"), ("n", "<u2"), ("gap", "u1"), ("tf", "u1"), ("best", "<u4")])
BEST = np.dtype([("tf", "<u4"), ("n", "<u4")])


def _widths(top: np.ndarray) -> np.ndarray:
    return np.where(top < 1 << 8, 1, np.where(top < 1 << 16, 2, 4)).astype(np.int64)


def _put(body: np.ndarray, at: np.ndarray, value: np.ndarray, width: np.ndarray) -> None:
    for k in range(4):
        some = width > k
        body[at[some] + k] = (value[some] >> (8 * k)) & 255


def _best_pairs(block: np.ndarray, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Positions of each block's pairs that no other beats in both, more occurrences and a shorter document."""
    order = np.lexsort((n, -tf, block))
    b, length = block[order], n[order]
    # Within a block, by falling count, a pair stays if its document is shorter than all before it.
    shifted = length + (b.max() - b) * (int(length.max()) + 1)
    least = np.minimum.accumulate(shifted)
    first = np.r_[True, b[1:] != b[:-1]]
    return order[first | np.r_[False, shifted[1:] < least[:-1]]]


class _Shard:
    """Term occurrences of some documents, and the index rows that they become."""

    def __init__(self) -> None:
        self.keys, self.checks, self.docs, self.spelling = [], [], [], []
        self.ids, self.lengths, self.n_docs, self.n_terms = [], [], 0, 0

    def add(self, ids: pa.Array, data: np.ndarray, offsets: np.ndarray) -> None:
        text = LOWER[data]
        start, end, row = words(text, offsets, NO_TERM)
        first = word_hashes(text, start, end)
        self.lengths.append(np.bincount(row, minlength=len(offsets) - 1))
        self.ids.append(ids)
        key, pick, back = np.unique(first, return_index=True, return_inverse=True)
        # A second hash of other powers tells apart terms that share the first.
        check = word_hashes(text[::-1], len(text) - end[::-1], len(text) - start[::-1])[::-1] if len(start) else first
        if np.any(check[pick][back] != check):
            pair = np.stack([first, check], axis=1)
            _, pick = np.unique(pair, axis=0, return_index=True)
        self.spelling.append((first[pick], check[pick], [text[a:b].tobytes() for a, b in zip(start[pick], end[pick], strict=True)]))
        self.keys.append(first)
        self.checks.append(check)
        self.docs.append(row + self.n_docs)
        self.n_docs += len(offsets) - 1
        self.n_terms += len(first)

    def full(self) -> bool:
        return self.n_terms >= SHARD_TERMS or self.n_docs >= SHARD_DOCS

    def rows(self, shard: int) -> Iterator[pa.RecordBatch]:
        length = np.concatenate(self.lengths)
        ids = pa.concat_arrays(self.ids)
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        numbers = ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8")
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
            ([shard], [None], [int((length > 0).sum())], [int(length.sum())], [length.astype("<u4").tobytes()],
             [numbers.tobytes() + known.astype("u1").tobytes()]), OUT.types, strict=True)], schema=OUT)
        if self.n_terms:
            yield from self._lists(shard, length)

    def _lists(self, shard: int, length: np.ndarray) -> Iterator[pa.RecordBatch]:
        key, check, doc = (np.concatenate(x) for x in (self.keys, self.checks, self.docs))
        order = np.argsort(key, kind="stable")
        key, check, doc = key[order], check[order], doc[order]
        same_key = key[1:] == key[:-1]
        if np.any(same_key & (check[1:] != check[:-1])):
            order = np.lexsort((doc, check, key))
            key, check, doc = key[order], check[order], doc[order]
        new_term = np.r_[True, (key[1:] != key[:-1]) | (check[1:] != check[:-1])]
        new = np.flatnonzero(new_term | np.r_[True, doc[1:] != doc[:-1]])
        tf = np.diff(np.r_[new, len(doc)])
        term = (np.cumsum(new_term) - 1)[new]
        doc, n = doc[new], length[doc[new]]
        begin = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
        df = np.diff(np.r_[begin, len(term)])
        within = np.arange(len(term)) - np.repeat(begin, df)
        opens = within % BLOCK == 0
        block = np.cumsum(opens) - 1
        first = np.flatnonzero(opens)
        count = np.diff(np.r_[first, len(term)])
        gap = np.where(opens, doc, np.diff(doc, prepend=0))
        w_gap, w_tf = _widths(np.maximum.reduceat(gap, first)), _widths(np.maximum.reduceat(tf, first))
        size = count * (w_gap + w_tf)
        place = np.cumsum(size) - size
        body = np.zeros(int(size.sum()), np.uint8)
        inside = np.arange(len(term)) - first[block]
        _put(body, place[block] + inside * w_gap[block], gap, w_gap[block])
        _put(body, place[block] + (count * w_gap)[block] + inside * w_tf[block], tf, w_tf[block])
        best = _best_pairs(block, tf, n)
        pairs = np.zeros(len(best), BEST)
        pairs["tf"], pairs["n"] = tf[best], n[best]
        n_best = np.bincount(block[best], minlength=len(first))
        blocks_of = np.r_[block[begin], len(first)]
        body_at = np.r_[place[blocks_of[:-1]], len(body)]
        best_at = np.r_[0, np.cumsum(n_best)][blocks_of]
        heads = np.zeros(len(first), HEAD)
        list_of = np.repeat(np.arange(len(begin)), np.diff(blocks_of))
        heads["last"], heads["n"] = doc[first + count - 1], count
        heads["at"], heads["gap"], heads["tf"], heads["best"] = place - body_at[list_of], w_gap, w_tf, n_best
        spelled = {}
        for keys, checks, texts in self.spelling:
            spelled.update(zip(zip(keys.tolist(), checks.tolist(), strict=True), texts, strict=True))
        at = np.flatnonzero(new_term)
        names = [spelled[k] for k in zip(key[at].tolist(), check[at].tolist(), strict=True)]
        head_bytes, pair_bytes, body_bytes = heads.tobytes(), pairs.tobytes(), body.tobytes()
        total = np.add.reduceat(tf, begin)
        for a in range(0, len(begin), 4096):
            some = range(a, min(a + 4096, len(begin)))
            yield pa.RecordBatch.from_arrays([
                pa.array([shard] * len(some), pa.int64()),
                pa.array([names[i].decode(errors="replace") for i in some], pa.string()),
                pa.array(df[some.start:some.stop], pa.int64()), pa.array(total[some.start:some.stop], pa.int64()),
                pa.array([head_bytes[HEAD.itemsize * blocks_of[i]:HEAD.itemsize * blocks_of[i + 1]]
                          + pair_bytes[BEST.itemsize * best_at[i]:BEST.itemsize * best_at[i + 1]] for i in some], pa.binary()),
                pa.array([body_bytes[body_at[i]:body_at[i + 1]] for i in some], pa.binary())], schema=OUT)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, number, shard = TaskContext.get().partitionId(), 0, _Shard()
    for batch in batches:
        data, offsets = column_bytes(batch.column("text"))
        for a, b in chunks(offsets):
            shard.add(batch.column("doc_id").slice(a, b - a), data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            if shard.full():
                yield from shard.rows((task << 32) + number)
                number, shard = number + 1, _Shard()
    if shard.n_docs:
        yield from shard.rows((task << 32) + number)


def build(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The written index: for each shard a row of its documents (null term) and a row for each term.

    A shard holds whole documents that follow each other in the input, about SHARD_TERMS occurrences.  A list is cut into blocks of
    128 documents; a block has gaps and counts in as few bytes as its largest needs, and its head the best pairs of
    count and length, whose highest impact bounds the block for every length of the average document.

    Every document and term is indexed; texts never move between tasks.  Null and empty texts are documents without terms.
    Null ids, repeated ids and repeated rows are documents of their own.  Runs a job.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return keep(rows.mapInArrow(_index, INDEX), "index")


def terms_of(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.translate(text, UPPER, LOWER_CASE), F.lit(TERM), F.lit(0)))


class _List:
    """One term's list in a shard: heads read at once, blocks when asked for."""

    def __init__(self, df: int, heads: bytes, body: bytes, length: np.ndarray, n_docs: int, n_total: int) -> None:
        n = -(-df // BLOCK)
        self.heads = np.frombuffer(heads, HEAD, n)
        pairs = np.frombuffer(heads, BEST, offset=n * HEAD.itemsize)
        self.length, self.body, self.n_docs, self.n_total = length, body, n_docs, n_total
        first = np.r_[0, np.cumsum(self.heads["best"])[:-1]].astype(np.int64)
        self.block_best = np.maximum.reduceat(self.impact(pairs["tf"], pairs["n"]), first)
        self.best, self.last = int(self.block_best.max()), self.heads["last"].astype(np.int64)
        self.read: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.whole: tuple[np.ndarray, np.ndarray] | None = None

    def impact(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        tf, n = tf.astype(np.int64), n.astype(np.int64)
        m = 100 - LENGTH_PERCENT + LENGTH_PERCENT * n * self.n_docs // self.n_total
        return SCALE * tf // (1000 * tf + SATURATION * m)

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        if b not in self.read:
            head = self.heads[b]
            n, at = int(head["n"]), int(head["at"])
            gap = np.frombuffer(self.body, f"<u{head['gap']}", n, at)
            tf = np.frombuffer(self.body, f"<u{head['tf']}", n, at + n * int(head["gap"]))
            doc = np.cumsum(gap, dtype=np.int64)
            self.read[b] = doc, self.impact(tf, self.length[doc])
        return self.read[b]

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        if self.whole is None:
            parts = [self.block(b) for b in range(len(self.heads))]
            self.whole = tuple(np.concatenate(x) for x in zip(*parts, strict=True))
            self.read = dict.fromkeys(self.read)
        return self.whole


def _kth(values: np.ndarray, k: int) -> int:
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else 0


def _best_of(lists: list[tuple[int, _List]], n_docs: int, least: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a shard that may be among the ``top`` best of all, with whole scores; ``least`` is known to be reached.

    Lists go by falling bound.  Once the bounds of the rest sum to less than the score to beat, only documents already
    met can win: the rest is not essential.  There a document is dropped when its score, its block's maximum and the
    bounds still to come cannot reach that score, and only blocks with a document left are decompressed.
    """
    lists = sorted(((w * x.best, w, x) for w, x in lists), key=lambda x: -x[0])
    rest, score = sum(bound for bound, _, _ in lists), np.zeros(n_docs, np.int64)
    essential = 0
    for bound, w, x in lists:
        if rest < least:
            break
        doc, impact = x.all()
        score[doc] += w * impact
        rest, essential = rest - bound, essential + 1
        if rest:
            least = max(least, _kth(score, top))
    doc = np.flatnonzero(score)
    doc = doc[score[doc] + rest >= least]
    own = score[doc]
    for bound, w, x in lists[essential:]:
        rest -= bound
        block = np.searchsorted(x.last, doc)
        most = np.r_[x.block_best, 0][block] * w
        alive = own + most + rest >= least
        doc, own, block = doc[alive], own[alive], block[alive]
        for b in np.unique(block[block < len(x.last)]).tolist():
            members, impact = x.block(b) if x.whole is None else x.all()
            mine = np.flatnonzero(block == b)
            at = np.minimum(np.searchsorted(members, doc[mine]), len(members) - 1)
            hit = members[at] == doc[mine]
            own[mine[hit]] += w * impact[at[hit]]
        least = max(least, _kth(own, top))
    return doc[own >= max(least, 1)], own[own >= max(least, 1)]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    rows, shard = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if row["shard"] != shard and rows:
                yield rows
                rows = []
            shard = row["shard"]
            rows.append(row)
    if rows:
        yield rows


def _searcher(queries: dict[int, list[tuple[str, int]]], n_docs: int, n_total: int, top: int):
    """Each task keeps one heap of ``top`` documents for each query over all of its shards."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = {q: (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for q in queries}
        for rows in _shards(batches):
            meta = next(r for r in rows if r["term"] is None)
            length = np.frombuffer(meta["heads"], "<u4")
            ids = np.frombuffer(meta["body"], "<i8", len(length))
            known = np.frombuffer(meta["body"], "u1", len(length), 8 * len(length)).astype(bool)
            lists = {r["term"]: _List(r["df"], r["heads"], r["body"], length, n_docs, n_total) for r in rows if r["term"] is not None}
            for q, terms in queries.items():
                asked = [(w, lists[t]) for t, w in terms if t in lists]
                if not asked:
                    continue
                score, doc_id, is_known = heaps[q]
                doc, own = _best_of(asked, len(length), int(score[-1]) if len(score) == top else 1, top)
                if len(doc):
                    score, doc_id = np.r_[score, own], np.r_[doc_id, ids[doc]]
                    is_known = np.r_[is_known, known[doc]]
                    order = np.lexsort((doc_id, ~is_known, -score))[:top]
                    heaps[q] = score[order], doc_id[order], is_known[order]
        found = [(q, i if ok else None, s) for q, heap in heaps.items()
                 for s, i, ok in zip(*(x.tolist() for x in heap), strict=True)]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)],
                                             ["q", "doc_id", "score"])
    return search


def _query_blocks(asked: DataFrame) -> Iterator[dict[int, list[tuple[str, int]]]]:
    """The queries in blocks of about QUERY_TERMS terms, read one after the other; one longer query is a block."""
    block, size, last = {}, 0, None
    for row in asked.orderBy("q", "term").toLocalIterator():
        if row["q"] != last and size >= QUERY_TERMS:
            yield block
            block, size = {}, 0
        last, size = row["q"], size + 1
        block.setdefault(row["q"], []).append((row["term"], row["w"]))
    if block:
        yield block


def search(index: DataFrame, queries: DataFrame, item_id: str = "item_id", text: str = "text", top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: for each query the ``top`` documents of highest score above 0.

    1. Counts over the whole index give the number of documents with terms, the terms' total and the weights.
    2. Queries are taken in blocks against all documents.  The lists that a block asks for go to their shard's task, where
       Block-Max MaxScore reads them; the heaps of all tasks are merged by a rank limit.

    Equal scores go by ascending doc_id, null ids last.  Queries without a known term, and null or empty ones, have no rows.  A query
    row repeated as it is counts once; one id with several texts has a ranking for each.  Repeated documents are ranked
    each.  No documents give no rows.  Runs jobs.
    """
    spark = index.sparkSession
    named = keep(queries.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).distinct()
                 .withColumn("q", F.monotonically_increasing_id()), "queries")
    terms = named.select("q", F.explode(terms_of(F.col("text"))).alias("term"))
    totals = index.where("term IS NULL").agg(F.sum("df").alias("n"), F.sum("total").alias("l")).first()
    schema = "q long, doc_id long, score long"
    found = spark.createDataFrame([], schema)
    if totals["l"]:
        lists = index.where("term IS NOT NULL")
        counts = lists.join(terms.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
        weight = F.floor(1000 * F.log(F.lit(float(2 * totals["n"] + 2)) / (2 * F.col("df") + 1)))
        asked = keep(terms.join(counts.select("term", weight.alias("w")).where("w > 0"), "term"), "asked")
        for block in _query_blocks(asked):
            first, last = min(block), max(block)
            wanted = asked.where(F.col("q").between(first, last)).select("term").distinct()
            near = lists.join(wanted, "term", "left_semi").unionByName(index.where("term IS NULL"))
            shards = near.repartition("shard").sortWithinPartitions("shard")
            run = _searcher(block, totals["n"], totals["l"], top)
            found = found.unionAll(keep(shards.mapInArrow(run, schema), "heaps"))
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top) \
        .join(named.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")
