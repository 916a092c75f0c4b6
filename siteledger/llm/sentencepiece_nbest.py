"""SentencePiece encoding by N-best segmentation (forward Viterbi, backward A*), and decoding."""

from __future__ import annotations

import heapq
import itertools
import math
import re
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, functions as F

SPACE = "▁"
# The score of a byte piece, which stands in for a character without a piece, below all others.
BYTE_PENALTY = 10.0
CACHE_CHUNKS = 160_000
LEAST_CUTOFF = 256.0
# Characters of texts whose chunks are looked up together, chunks searched in step, longest of these, and ids decoded together.
GROUP_CHARS, IN_STEP, WIDEST, GROUP_IDS = 1_000_000, 4096, 32, 250_000
# Slots of the table of pieces, several for each, and the multiplier and shift that spread keys over them.
SLOTS, MIX, SHIFT = 2 ** 18, np.uint64(0x9E3779B97F4A7C15), np.uint64(46)
# Chunks end before a space, and between a letter and an ASCII mark.  No piece crosses either (``Pieces`` makes sure),
# so a text's segmentations are those of its chunks side by side.
LETTER, MARK = r"[^\W\d_²³¹]", r"[!-/:-@\[-`{-~\n]"
CROSSING = re.compile(f"[^ ] |{LETTER}{MARK}")
CHUNK = re.compile(f" *{LETTER}+(?=[ \\n]|{MARK}|$)| *(?:[^ ](?!(?<={LETTER}){MARK}))*[^ ]| +")


class Pieces:
    """Pieces of a model with their ids, scores and bytes."""

    def __init__(self, model: str):
        loaded = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
        self.ids: dict[str, int] = {}
        self.scores: dict[int, float] = {}
        self.shown: list[bytes] = []
        byte_ids: dict[int, int] = {}
        for i in range(loaded.get_piece_size()):
            piece = loaded.id_to_piece(i)
            if loaded.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                self.shown.append(bytes([int(piece[3:5], 16)]))
            elif loaded.is_control(i) or loaded.is_unknown(i) or loaded.is_unused(i):
                self.shown.append(b"")
            else:
                spaced = piece.replace(SPACE, " ")
                self.ids[spaced] = i
                self.scores[i] = loaded.get_score(i)
                self.shown.append(spaced.encode())
        if any(map(CROSSING.search, self.ids)):
            raise ValueError("a piece of this model goes on past the end of a chunk")
        least = min(s for s in self.scores.values() if s > -1e8)
        self.byte_ids, self.byte_score = byte_ids, least - BYTE_PENALTY
        # Pieces, and the beginnings of pieces that are none themselves (id -1).
        self.known = {piece[:k]: (-1, 0.0) for piece in self.ids for k in range(1, len(piece) + 1)}
        self.known |= {piece: (i, self.scores[i]) for piece, i in self.ids.items()}
        # The same as a trie for arrays, with the characters of one byte that have no piece: nodes are these strings, keys a
        # node and the kind of character after it.
        known = self.known | {chr(b): (i, self.byte_score) for b, i in byte_ids.items() if b < 128 and chr(b) not in self.ids}
        kinds = {c: k for k, c in enumerate(sorted(set("".join(known))))}
        self.end, self.span = len(kinds), len(kinds) + 1
        self.kind = np.full(0x110000, -1, np.int32)
        for c in kinds:
            if known.get(c, (-1,))[0] >= 0:
                self.kind[ord(c)] = kinds[c]
        nodes = {text: k for k, text in enumerate(["", *known])}
        keys = np.array([nodes[text[:-1]] * self.span + kinds[text[-1]] for text in known], np.int64)
        self.keys, self.child = np.full(SLOTS, -1, np.int64), np.zeros(SLOTS, np.int64)
        slot, left = self.slot(keys), np.arange(len(keys))
        while len(left):
            # Of several for one slot the last stays; the others try the next one.
            free = self.keys[slot[left]] < 0
            self.keys[slot[left[free]]], self.child[slot[left[free]]] = keys[left[free]], left[free] + 1
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) % SLOTS
        self.piece = np.array([-1, *(i for i, _ in known.values())], np.int32)
        self.score = np.array([0.0, *(s for _, s in known.values())])
        self.depth = np.array([len(text) for text in nodes], np.int64)
        # Sums of whole numbers are the same in any order, so scores and ties are those of ``best``.
        self.whole = bool(np.all((self.score == np.rint(self.score)) & (np.abs(self.score) < 2 ** 40)))

    @staticmethod
    def slot(key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * MIX >> SHIFT).astype(np.int64)

    def step(self, node: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which nodes have a child for this kind of character, and the children of those."""
        key = node * self.span + kind
        slot = self.slot(key)
        found = self.keys[slot]
        other = np.flatnonzero((found != key) & (found >= 0))
        while len(other):
            slot[other] = (slot[other] + 1) % SLOTS
            found[other] = self.keys[slot[other]]
            other = other[(found[other] != key[other]) & (found[other] >= 0)]
        hit = np.flatnonzero(found == key)
        return hit, self.child[slot[hit]]

    def forward(self, chunk: str) -> tuple[list[list[tuple]], list[float]]:
        """Viterbi: for each end position the pieces (begin, ids, score) there, and the best score up to it."""
        n, known = len(chunk), self.known
        ends: list[list] = [[] for _ in range(n + 1)]
        ahead = [0.0] + [-math.inf] * n
        for i in range(n):
            base = ahead[i]
            if chunk[i] not in self.ids:
                raw = chunk[i].encode()
                score = self.byte_score * len(raw)
                ends[i + 1].append((i, tuple([self.byte_ids[b] for b in raw]), score))
                ahead[i + 1] = max(ahead[i + 1], base + score)
            for j in range(i + 1, n + 1):
                found = known.get(chunk[i:j])
                if found is None:
                    break
                if found[0] >= 0:
                    ends[j].append((i, found[:1], found[1]))
                    if base + found[1] > ahead[j]:
                        ahead[j] = base + found[1]
        return ends, ahead

    def best(self, chunk: str, count: int, cutoff: float = math.inf) -> list[tuple[float, tuple[int, ...]]]:
        """The ``count`` best segmentations of a chunk that score at most ``cutoff`` below the best.

        A forward Viterbi pass gives the best score of each prefix.  Backward A* from the chunk's end uses it as
        the estimate of what is left; being exact, it makes complete paths leave the queue in order of
        score, and it never enters a path that ends below the cutoff.  A position is left at most ``count``
        times, as more ways from it to the end can't be among the best, so ties (a long run of one letter has any
        number) cost no more than other texts.  Equal scores come in the order of the search, always the same.
        """
        ends, ahead = self.forward(chunk)
        least = ahead[-1] - cutoff
        queue: list[tuple] = [(-ahead[-1], 0, len(chunk), 0.0, None)]
        left = [0] * len(ends)
        done: list[tuple[float, tuple[int, ...]]] = []
        pop, push, turn = heapq.heappop, heapq.heappush, 0
        while queue and len(done) < count:
            _, _, at, score, path = pop(queue)
            if not at:
                ids: list[int] = []
                while path is not None:
                    ids += path[0]
                    path = path[1]
                done.append((score, tuple(ids)))
                continue
            if left[at] >= count:
                continue
            left[at] += 1
            for i, ids_, s in ends[at]:
                whole = score + s + ahead[i]
                if whole >= least:
                    turn += 1
                    push(queue, (-whole, turn, i, score + s, (ids_, path)))
        return done

    def best_of_many(self, chunks: list[str]) -> list[tuple[bytes, float, float] | None]:
        """For each chunk the best ids, how much the second best scores less, and the best score.

        The forward pass over all chunks in step, with the two best scores of each prefix.  None for a chunk that needs
        ``best``: several are equally good, a longer character has no piece, or it is longer than ``WIDEST``.
        """
        out: list[tuple[bytes, float, float] | None] = [None] * len(chunks)
        if not self.whole or not chunks:
            return out
        size = np.fromiter(map(len, chunks), np.int64, len(chunks))
        kind = self.kind[np.frombuffer("".join(chunks).encode("utf-32-le"), "<u4")]
        begin = np.cumsum(size) - size
        fits = np.flatnonzero((size <= WIDEST) & (np.minimum.reduceat(kind, begin) >= 0))
        # Chunks of like length together.
        fits = fits[np.argsort(size[fits], kind="stable")]
        for a in range(0, len(fits), IN_STEP):
            some = fits[a:a + IN_STEP]
            for k, found in zip(some.tolist(), self._in_step(kind, begin[some], size[some]), strict=True):
                out[k] = found
        return out

    def _in_step(self, kind: np.ndarray, begin: np.ndarray, size: np.ndarray):
        n, width = len(size), int(size.max())
        text = np.full((width, n), self.end, np.int64)
        for j in range(width):
            longer = np.flatnonzero(size > j)
            text[j, longer] = kind[begin[longer] + j]
        first, second = np.full((width + 1, n), -np.inf), np.full((width + 1, n), -np.inf)
        first[0] = 0.0
        came = np.zeros((width + 1, n), np.int64)
        for i in range(width):
            at, node = np.arange(n), np.zeros(n, np.int64)
            for j in range(i, width):
                hit, node = self.step(node, text[j, at])
                at = at[hit]
                if not len(at):
                    break
                ends = np.flatnonzero(self.piece[node] >= 0)
                to, piece = at[ends], node[ends]
                now, score = first[j + 1, to], self.score[piece]
                new = first[i, to] + score
                second[j + 1, to] = np.maximum(np.maximum(second[j + 1, to], second[i, to] + score), np.minimum(now, new))
                first[j + 1, to] = np.maximum(now, new)
                better = np.flatnonzero(new > now)
                came[j + 1, to[better]] = piece[better]
        all_ = np.arange(n)
        top, loss = first[size, all_], first[size, all_] - second[size, all_]
        ids, head = np.zeros((n, width), np.int32), np.full(n, width)
        left, at = size.copy(), all_
        while len(at):
            piece = came[left[at], at]
            head[at] -= 1
            ids[at, head[at]] = self.piece[piece]
            left[at] -= self.depth[piece]
            at = at[left[at] > 0]
        raw, tail = ids.tobytes(), 4 * width * (all_ + 1)
        heads = (tail - 4 * (width - head)).tolist()
        for a, b, less, score in zip(heads, tail.tolist(), loss.tolist(), top.tolist(), strict=True):
            yield (raw[a:b], less, score) if less > 0 else None


class Encoder:
    """Whole texts, with the chunks seen lately; two generations keep frequent chunks when one is full."""

    def __init__(self, model: str, count: int):
        self.pieces, self.count = Pieces(model), count
        self.new: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    def search(self, chunk: str, cutoff: float) -> tuple[bytes, float, float, float, list[tuple[float, bytes]]]:
        """Best ids, least loss of another segmentation, best score, loss up to which others are known, these with theirs."""
        # A generous limit serves most later texts too; the least loss has to be known in any case.
        for cutoff in (max(cutoff, LEAST_CUTOFF), math.inf):
            ranked = [(s, array("i", ids).tobytes()) for s, ids in self.pieces.best(chunk, self.count, cutoff)]
            if len(ranked) >= min(self.count, 2):
                break
        top = ranked[0][0]
        known = cutoff if len(ranked) < self.count else math.inf
        others = [(top - s, ids) for s, ids in ranked[1:]]
        least = others[0][0] if others else math.inf
        self.new[chunk] = found = ranked[0][1], least, top, known, others
        return found

    def learn(self, chunks: list[str]) -> None:
        """Bring all of these into the newer generation."""
        if len(self.new) >= CACHE_CHUNKS:
            self.old, self.new = self.new, {}
        unseen = []
        for chunk in chunks:
            if chunk not in self.new:
                found = self.old.get(chunk)
                if found is None:
                    unseen.append(chunk)
                else:
                    self.new[chunk] = found
        # Others of a chunk are searched for when they matter to a text: few are so close to the best.
        for chunk, found in zip(unseen, self.pieces.best_of_many(unseen), strict=True):
            if found is None:
                self.search(chunk, LEAST_CUTOFF)
            else:
                ids, loss, top = found
                self.new[chunk] = ids, loss, top, math.nextafter(loss, 0.0), ()

    def encode_all(self, texts: list[str | None]) -> Iterator[list[tuple[float, bytes]]]:
        """The best segmentations of each text."""
        a, chars = 0, 0
        for b, text in enumerate(texts, 1):
            chars += len(text or "")
            if chars >= GROUP_CHARS or b == len(texts):
                yield from self._together(texts[a:b])
                a, chars = b, 0

    def encode(self, text: str | None) -> list[tuple[float, bytes]]:
        return next(self.encode_all([text]))

    def _together(self, texts: list[str | None]) -> Iterator[list[tuple[float, bytes]]]:
        split = [CHUNK.findall(" " + text) if text else [] for text in texts]
        chunks = list(set().union(*split))
        self.learn(chunks)
        found = list(map(self.new.__getitem__, chunks))
        place = dict(zip(chunks, range(len(chunks)), strict=True))
        of = np.fromiter(map(place.__getitem__, itertools.chain.from_iterable(split)), np.int64, sum(map(len, split)))
        loss, top = (np.array([f[k] for f in found], np.float64)[of] for k in (1, 2))
        # The best ids of all texts, one chunk after the other, and where each chunk's begin.
        size = np.array([len(f[0]) // 4 for f in found], np.int64)
        begin = np.concatenate([[0], np.cumsum(size[of])])
        source = np.repeat((np.cumsum(size) - size)[of] - begin[:-1], size[of])
        ids = np.frombuffer(b"".join([f[0] for f in found]), "<i4")[np.arange(begin[-1]) + source].tobytes()
        a = 0
        for own in split:
            b = a + len(own)
            yield self._ranked(found, of[a:b], own, loss[a:b], sum(top[a:b].tolist()), ids, 4 * begin[a:b + 1])
            a = b

    def _ranked(self, found: list, of: np.ndarray, chunks: list[str], losses: np.ndarray, total: float, best: bytes,
                begin: np.ndarray) -> list[tuple[float, bytes]]:
        """The best segmentations of a text, given its chunks, all of them learnt: (score, ids).

        Chunks are independent, so a text's best ones take the best of each chunk but for a few.  Only the
        ``count - 1`` cheapest departures can occur in them: any other has that many, and the best itself,
        before it.  Only chunks that have one of these are searched for others.
        """
        if not chunks:
            return [(0.0, b"")]
        wanted = self.count - 1
        last = math.inf if len(losses) < wanted else np.partition(losses, wanted - 1)[wanted - 1] if wanted else -1.0
        near = np.flatnonzero(losses <= last).tolist()
        for k in near:
            if found[of[k]][3] < last:
                found[of[k]] = self.search(chunks[k], last)
        departures = sorted((loss, k, rank, ids) for k in near for rank, (loss, ids) in enumerate(found[of[k]][4])
                            if loss <= last)[:wanted]
        options = []
        for size in range(len(departures) + 1):
            for some in itertools.combinations(departures, size):
                if len({d[1] for d in some}) == size:
                    options.append((sum(d[0] for d in some), [d[1:3] for d in some], some))
        options.sort(key=lambda o: o[:2])
        out = []
        for loss, _, some in options[:self.count]:
            parts, at = [], begin[0]
            for _, k, _, ids in sorted(some, key=lambda d: d[1]):
                parts += [best[at:begin[k]], ids]
                at = begin[k + 1]
            out.append((total - loss, b"".join([*parts, best[at:begin[-1]]])))
        return out


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(model: str, count: int) -> Encoder:
    """The worker's encoder, kept over tasks."""
    if (model, count) not in _encoders:
        _encoders[model, count] = Encoder(model, count)
    return _encoders[model, count]


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", count: int = 3,
           model: str = "piece_bpe_32k.model") -> DataFrame:
    """doc_id, rank (from 1), score, ids for each of the ``count`` best segmentations of every whole text.

    A text gets a leading space, as the model's own encoder gives it; characters without a piece become
    byte pieces.  The score is the sum of the pieces' scores.  Fewer rows come out if a text has fewer segmentations.
    Null and empty texts have one, without ids.  Rows are answered each, also repeated ones and null ids; no rows
    give no rows; other columns are not looked at.
    """
    kind = docs.select(F.col(doc_id).alias("doc_id")).schema["doc_id"].dataType.simpleString()

    def run(batches):
        made = encoder(model, count)
        for batch in batches:
            row, rank, score, ids = [], [], [], []
            for k, best in enumerate(made.encode_all(batch.column("text").to_pylist())):
                for r, (s, found) in enumerate(best, 1):
                    row.append(k)
                    rank.append(r)
                    score.append(s)
                    ids.append(found)
            ends = np.cumsum([0] + [len(x) // 4 for x in ids]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(rank, pa.int32()),
                 pa.array(score, pa.float64()), pa.ListArray.from_arrays(pa.array(ends), values)],
                names=["doc_id", "rank", "score", "ids"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, rank int, score double, ids array<int>")


def decode(encoded: DataFrame, ids: str = "ids", out: str = "text", model: str = "piece_bpe_32k.model") -> DataFrame:
    """``encoded`` with the text of its ids; null ids give null.  Inverts ``encode`` exactly.

    Bytes that are no UTF-8 (only in ids that ``encode`` did not make) become replacement characters.
    """
    @F.arrow_udf("string")
    def text_of(lists: pa.Array) -> pa.Array:
        shown = pa.array(encoder(model, 1).pieces.shown, pa.binary())
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
        ids, ends = lists.flatten(), np.cumsum(sizes)
        texts, a = [pa.array([], pa.string())], 0
        while a < len(sizes):
            start = int(ends[a] - sizes[a])
            b = max(a + 1, int(np.searchsorted(ends, start + GROUP_IDS, "right")))
            pieces = shown.take(ids[start:int(ends[b - 1])])
            at = np.frombuffer(pieces.buffers()[1], np.int32)[:len(pieces) + 1]
            raw = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)[:at[-1]]
            begin = at[np.concatenate([[0], ends[a:b] - start])]
            spaced = (begin[:-1] < begin[1:]) & (np.append(raw, 0)[begin[:-1]] == ord(" "))
            raw = np.delete(raw, begin[:-1][spaced])
            begin = (begin - np.concatenate([[0], np.cumsum(spaced)])).astype(np.int32)
            found = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(begin), pa.py_buffer(raw)])
            try:
                texts.append(found.cast(pa.string()))
            except pa.ArrowInvalid:
                texts.append(pa.array([x.decode("utf-8", "replace") for x in found.to_pylist()], pa.string()))
            a = b
        return pc.if_else(lists.is_valid(), pa.concat_arrays(texts), pa.scalar(None, pa.string()))

    return encoded.withColumn(out, text_of(F.col(ids)))
