"""Cost-balanced packing of tokenised documents into sequences of bounded length."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from .workers import free, held

END = 1
CAPACITY = 2048
# Attention work of a piece of n tokens: LINEAR * n for projections and feed-forward, QUADRATIC * n^2
# for scores; the ratio is that of a model of width 1024 (12 d^2 n against 2 d n^2).
LINEAR, QUADRATIC = 6144.0, 1.0
# Tokens packed together; also what a task holds at most, besides one document.
BUFFER_TOKENS = 2_000_000
CACHE_WORDS = 600_000
TEXTS_AT_ONCE = 64
LETTER, DIGIT = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
# The vocabulary's own splitting rule, for lower-cased text of ASCII and Latin-1.
WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{DIGIT}]|[^\\s{LETTER}{DIGIT}]+")
PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-\xff]*")


class Encoder:
    """A vocabulary with the ids of words seen so far (little-endian 32-bit); emptied when full."""

    def __init__(self, vocabulary: str, cache_words: int = CACHE_WORDS):
        self.cache_words = cache_words
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.path = public_tokenizers.path(vocabulary)
        with open(self.path, encoding="utf-8") as file:
            rules = json.load(file)
        # Found anywhere in a text before it is split; lower-cased, as some are looked for in normalised text.
        added = [re.escape(t["content"].lower()) for t in rules["added_tokens"]]
        self.added = re.compile("|".join(added) or "(?!)")
        # For single words that are already split and lower-cased.
        rules |= {"normalizer": None, "added_tokens": [],
                  "pre_tokenizer": rules["pre_tokenizer"]["pretokenizers"][-1]}
        self.of_word = Tokenizer.from_str(json.dumps(rules))
        self.known: dict[str, bytes] = {}

    @cached_property
    def whole(self) -> Tokenizer:
        """The vocabulary as it is; loaded only where a text needs it, as it takes much memory."""
        return Tokenizer.from_file(self.path)

    def learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > self.cache_words:
            self.known.clear()
        unknown = list(words.difference(self.known))
        for word, found in zip(unknown, self.of_word.encode_batch_fast(unknown, add_special_tokens=False),
                               strict=True):
            self.known[word] = np.array(found.ids, "<u4").tobytes()

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text, equal to what the tokenizer gives for the whole text.

        The vocabulary merges inside words only, so a word's ids do not depend on its neighbours.
        Texts with characters beyond Latin-1 go to the tokenizer as they are, because its
        normalisation could differ from Python's there; so do texts that hold an added token.
        """
        for a in range(0, len(texts), TEXTS_AT_ONCE):
            part = [text or "" for text in texts[a:a + TEXTS_AT_ONCE]]
            lower = [t.lower() if PLAIN.fullmatch(t) else None for t in part]
            split = [None if t is None or self.added.search(t) else WORD.findall(t) for t in lower]
            self.learn(set().union(*filter(None, split)))
            for text, words in zip(part, split, strict=True):
                if words is None:
                    ids = self.whole.encode(text, add_special_tokens=False).ids
                    yield np.array(ids, "<u4").tobytes()
                else:
                    yield b"".join(map(self.known.__getitem__, words))


def encoder(vocabulary: str, cache_words: int = CACHE_WORDS) -> Encoder:
    """The worker's encoder for a vocabulary file, kept over tasks until another operator frees it."""
    return held(("packing", vocabulary, cache_words), lambda: Encoder(vocabulary, cache_words))


def cost(tokens: int) -> float:
    return LINEAR * tokens + QUADRATIC * tokens * tokens


def assign(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Pack documents: (document, start, length, sequence, offset) for each piece.

    Whole sequences are cut off documents longer than the capacity.  What is left over of each
    document goes, longest first, to the sequence of lowest cost among those with enough room; there
    are as many sequences as the tokens need.  A remainder that fits nowhere whole is cut
    and fills the cheapest sequences that have room.  The room still free at the end, less than one
    sequence, is closed by cutting the last sequence at powers of two, which take no padding.
    """
    pieces, rest, sequence = [], [], 0
    for doc, n in enumerate(lengths):
        for start in range(0, n - n % capacity, capacity):
            pieces.append((doc, start, capacity, sequence, 0))
            sequence += 1
        if n % capacity:
            rest.append((n % capacity, doc, n - n % capacity))
    rest.sort(key=lambda r: (-r[0], r[1]))
    total = sum(r[0] for r in rest)
    sizes = [capacity] * (total // capacity) + [1 << k for k in range(capacity.bit_length(), -1, -1)
                                                if total % capacity >> k & 1]
    room = np.array(sizes, np.int64)
    spent = np.zeros(len(sizes))
    sizes = np.array(sizes, np.int64)

    def place(doc: int, start: int, n: int, at: int) -> None:
        pieces.append((doc, start, n, sequence + at, int(sizes[at] - room[at])))
        room[at] -= n
        spent[at] += cost(n)

    for n, doc, start in rest:
        fits = np.where(room >= n, spent, np.inf)
        at = int(fits.argmin())
        while n and not np.isfinite(fits[at]):
            at = int(np.where(room > 0, spent, np.inf).argmin())
            part = min(n, int(room[at]))
            place(doc, start, part, at)
            n, start = n - part, start + part
            fits = np.where(room >= n, spent, np.inf)
            at = int(fits.argmin())
        if n:
            place(doc, start, n, at)
    return pieces


def _packed(ids: list[bytes], doc_ids: pa.Array, first: int, capacity: int) -> tuple[pa.RecordBatch, int]:
    pieces = assign([len(x) // 4 for x in ids], capacity)
    columns = list(zip(*pieces, strict=True)) if pieces else [()] * 5
    doc, start, length, sequence, offset = columns
    batch = pa.RecordBatch.from_arrays(
        [doc_ids.take(pa.array(doc, pa.int64())),
         pa.array(start, pa.int64()), pa.array(length, pa.int64()),
         pa.array([ids[d][4 * s:4 * (s + n)] for d, s, n in zip(doc, start, length, strict=True)], pa.binary()),
         pa.array([len(ids[d]) // 4 for d in doc], pa.int64()),
         pa.array([first + s for s in sequence], pa.int64()), pa.array(offset, pa.int64())],
        names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
    return batch, max(sequence, default=-1) + 1


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         vocabulary: str = "word_bpe_49k.json", buffer_tokens: int = BUFFER_TOKENS, cache_words: int = CACHE_WORDS,
         release: bool = False) -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset).

    ``ids`` are little-endian unsigned 32-bit token ids; a document's ids end with END.  Every id
    lies in one piece; a sequence's pieces are gapless from offset 0.  Each task packs its own
    rows in buffers of about ``buffer_tokens``, so nothing is shuffled, one source or group of copies
    weighs on no task, and memory is bounded by the buffer and one document.  sequence_id
    holds the partition in its upper 31 bits and a count in the lower 32: unique, and the same when
    a task is run again.  ``cache_words`` bounds the words whose ids a worker remembers; with ``release`` it forgets them and
    the vocabulary after each task, for jobs whose other stages left idle workers, which take turns.

    Null and empty texts have the one id END.  Rows with equal or null ids are packed each as
    a document of its own.  No rows give no pieces; other columns are not looked at.
    """
    kind = docs.select(F.col(doc_id).alias("doc_id")).schema["doc_id"].dataType.simpleString()
    end = np.array([END], "<u4").tobytes()

    def run(batches):
        first = TaskContext.get().partitionId() << 32
        ids, names, held, id_type = [], [], 0, None

        def flush():
            nonlocal first, ids, names, held
            batch, used = _packed(ids, pa.array(names, id_type), first, capacity)
            first, ids, names, held = first + used, [], [], 0
            return batch

        for batch in batches:
            id_type = batch.column("doc_id").type
            given = zip(batch.column("doc_id"), encoder(vocabulary, cache_words).encode(batch.column("text").to_pylist()), strict=True)
            for name, found in given:
                ids.append(found + end)
                names.append(name.as_py())
                held += len(found) // 4 + 1
                if held >= buffer_tokens:
                    yield flush()
        if ids:
            yield flush()
        if release:
            free()

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, "
             "sequence_id bigint, offset bigint")


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per packed sequence: n_tokens, cost and its pieces in order (at most ``capacity`` of them)."""
    n = F.col("length").cast("double")
    return pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.sum(F.lit(LINEAR) * n + F.lit(QUADRATIC) * n * n).alias("cost"),
        F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids"))).alias("pieces"))
