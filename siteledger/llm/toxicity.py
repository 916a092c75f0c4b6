"""Toxic spans and document scores by a linear-chain conditional random field."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .language_id import folds
from .textnum import LOWER, U64, chunks, column_bytes, mix, word_hashes, words
from .workers import free

# Bounds of the training sample: documents of each class, bytes of one document.
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_BYTES = 900, 1500, 16_000
TABLE_BITS = 18
PREFIXES = (4, 5, 6, 7)
WINDOW = 64
STEPS = 100
# Features of so few words in the training sample get no weight.
RARE = 4
CHUNK = 1 << 20
# ASCII characters that are no letters part words.
APART = np.zeros(256, bool)
APART[:128] = True
APART[65:91] = APART[97:123] = False


def fold(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and the accented capitals of Latin-1 lower-cased."""
    data = LOWER[data]
    if len(data) > 1:
        second = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        data[second] += 0x20
    return data


def features(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """32-bit hashes (words x features) of each word and of its first bytes."""
    made = [word_hashes(data, start, end)]
    for k, size in enumerate(PREFIXES):
        made.append(mix(word_hashes(data, start, np.minimum(end, start + size)) + U64(k + 1)))
    return (np.stack(made, axis=1) >> U64(32)).astype(np.uint32)


def chain(emission: np.ndarray, begin: np.ndarray, length: np.ndarray, switch: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward log-odds of the toxic state, and posterior log-odds, for many chains at once.

    ``switch`` holds the log weights of (clean-clean, clean-toxic, toxic-clean, toxic-toxic).  With
    two states the messages reduce to one number, the log-odds.  Chains step together, longest
    first, so that the active ones are always a prefix.
    """
    w00, w01, w10, w11 = np.exp(switch)
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    most = int(length[0]) if len(length) else 0
    alive = np.searchsorted(-length, -np.arange(most), side="left")
    ahead = np.empty_like(emission)
    back = np.zeros_like(emission)
    for step, n in enumerate(alive):
        at = begin[:n] + step
        if step:
            odds = np.exp(np.clip(ahead[at - 1], -40, 40))
            ahead[at] = emission[at] + np.log((odds * w11 + w01) / (odds * w10 + w00))
        else:
            ahead[at] = emission[at]
    for step in range(most - 2, -1, -1):
        at = begin[:alive[step + 1]] + step
        odds = np.exp(np.clip(emission[at + 1] + back[at + 1], -40, 40))
        back[at] = np.log((odds * w11 + w10) / (odds * w01 + w00))
    return ahead, back, ahead + back


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    """Emission weights by hashed feature (2**TABLE_BITS floats), transitions, and the document layer."""

    weights: np.ndarray
    bias: float
    switch: np.ndarray
    layer: np.ndarray

    def emission(self, hashed: np.ndarray) -> np.ndarray:
        return self.weights[hashed >> np.uint32(32 - TABLE_BITS)].sum(axis=1) + self.bias

    def tokens(self, data: np.ndarray, offsets: np.ndarray):
        """Start, end, row and posterior log-odds of every word; each text is one chain."""
        data = fold(data)
        start, end, row = words(data, offsets, APART)
        if not len(start):
            return start, end, row, np.zeros(0)
        begin = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        length = np.diff(np.r_[begin, len(row)])
        logit = chain(self.emission(features(data, start, end)), begin, length, self.switch)[2]
        return start, end, row, logit

    def scores(self, row: np.ndarray, logit: np.ndarray, n: int) -> np.ndarray:
        return sigmoid(summary(row, logit, n) @ self.layer)


def summary(row: np.ndarray, logit: np.ndarray, n: int) -> np.ndarray:
    """What a document's marginals come to: 1, the strongest, the logs of expected toxic words and words."""
    strongest = np.full(n, -15.0)
    np.maximum.at(strongest, row, np.clip(logit, -15, 15))
    expected = np.bincount(row, weights=sigmoid(logit), minlength=n)
    size = np.bincount(row, minlength=n)
    return np.stack([np.ones(n), strongest, np.log1p(expected), np.log1p(size)], axis=1)


def label_tokens(hashed: np.ndarray, row: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Token labels: in a toxic text, the words with a feature that tells toxic texts from clean ones.

    A feature tells them apart if its document counts give a log-likelihood ratio above 20 (one
    chance in about 100,000) and at least 80 per cent of its texts, weighted to equal classes, are toxic.
    """
    labels = np.zeros(len(row), bool)
    totals = np.array([max(1, (~toxic).sum()), max(1, toxic.sum())], float)
    for k in range(hashed.shape[1]):
        value, index = np.unique(hashed[:, k], return_inverse=True)
        seen = np.unique(index.astype(np.int64) * len(toxic) + row)
        counts = np.zeros((len(value), 2))
        np.add.at(counts, (seen // len(toxic), toxic[seen % len(toxic)].astype(int)), 1)
        share = (counts + 0.1) / totals
        both = counts.sum(axis=1, keepdims=True)
        expected = both * totals / totals.sum()
        ratio = 2 * (counts * np.log(np.maximum(counts, 1e-9) / expected)).sum(axis=1)
        telling = (ratio > 20) & (share[:, 1] >= 0.8 * share.sum(axis=1))
        labels |= telling[index] & toxic[row]
    return labels


def _train_chain(hashed: np.ndarray, row: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """Maximum conditional likelihood on windows of WINDOW words, by Adagrad steps.

    All windows with a toxic word are used, and twice as many of the others at even distances.
    Features of at most RARE training words get no weight, as for words never seen: so the bias
    learns what an unknown word means.
    """
    within = np.arange(len(row)) - np.flatnonzero(np.r_[True, row[1:] != row[:-1]])[
        np.cumsum(np.r_[True, row[1:] != row[:-1]]) - 1]
    head = np.flatnonzero(within % WINDOW == 0)
    size = np.diff(np.r_[head, len(row)])
    toxic = np.maximum.reduceat(labels, head)
    clean = np.flatnonzero(~toxic)
    step = max(1, len(clean) // max(1, 2 * int(toxic.sum())))
    chosen = np.sort(np.r_[np.flatnonzero(toxic), clean[::step]])
    head, size = head[chosen], size[chosen]
    begin = np.cumsum(size) - size
    at = np.repeat(head - begin, size) + np.arange(int(size.sum()))
    slot = hashed[at] >> np.uint32(32 - TABLE_BITS)
    uses = np.bincount((hashed >> np.uint32(32 - TABLE_BITS)).ravel(), minlength=1 << TABLE_BITS)
    shared = (uses > RARE).astype(float)
    truth = labels[at].astype(float)
    weights, bias, switch = np.zeros(1 << TABLE_BITS), float(np.log((truth.sum() + 1) / (len(truth) + 1))), np.zeros(4)
    gathered = np.full(1 << TABLE_BITS, 1e-6)
    gathered_rest = np.full(5, 1e-6)
    inner = np.ones(len(at), bool)
    inner[begin] = False
    later = np.flatnonzero(inner)
    observed = np.bincount((2 * truth[later - 1] + truth[later]).astype(int), minlength=4)
    for _ in range(STEPS):
        emission = weights[slot].sum(axis=1) + bias
        ahead, back, logit = chain(emission, begin, size, switch)
        wrong = sigmoid(logit) - truth
        gradient = np.zeros(1 << TABLE_BITS)
        for k in range(slot.shape[1]):
            gradient += np.bincount(slot[:, k], weights=wrong, minlength=1 << TABLE_BITS)
        gradient = (gradient + 0.02 * weights) * shared
        before = np.exp(np.clip(ahead[later - 1], -40, 40))
        after = np.exp(np.clip(emission[later] + back[later], -40, 40))
        w00, w01, w10, w11 = np.exp(switch)
        joint = np.stack([np.full(len(later), w00), w01 * after, w10 * before, w11 * before * after])
        expected = (joint / joint.sum(axis=0)).sum(axis=1)
        rest = np.r_[wrong.sum(), expected - observed + 0.05 * switch]
        gathered += gradient * gradient
        gathered_rest += rest * rest
        weights -= 1.0 * gradient / np.sqrt(gathered)
        bias -= 0.5 * rest[0] / np.sqrt(gathered_rest[0])
        switch = np.clip(switch - 0.3 * rest[1:] / np.sqrt(gathered_rest[1:]), -6, 6)
        switch -= switch[0]
    return weights.astype(np.float32), bias, switch


def _train_layer(x: np.ndarray, toxic: np.ndarray, share: float) -> np.ndarray:
    """Logistic regression by Newton steps; classes are weighted to their share among all labels."""
    weight = np.where(toxic, share / max(1, toxic.sum()), (1 - share) / max(1, (~toxic).sum())) * len(toxic)
    layer = np.zeros(x.shape[1])
    for _ in range(30):
        p = sigmoid(x @ layer)
        gradient = x.T @ (weight * (p - toxic)) + 1e-2 * layer
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        step = np.linalg.solve(curve, gradient)
        layer -= step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
    return layer


def train(texts: list[str], toxic: list[int], share: float) -> Model | None:
    """Model of labelled texts; None unless both classes occur.

    Of each class two thirds train the chain; the document layer learns from the others, whose
    marginals are like those of new texts (from all of them if the others lack a class).
    """
    marks = np.array(toxic, bool)
    if not marks.any() or marks.all():
        return None
    turn = np.zeros(len(marks), int)
    for mark in (False, True):
        turn[marks == mark] = np.arange((marks == mark).sum())
    for_chain = turn % 3 != 2
    data, offsets = column_bytes(pa.array([t for t, c in zip(texts, for_chain, strict=True) if c], pa.string()))
    folded = fold(data)
    start, end, row = words(folded, offsets, APART)
    if not len(row):
        return None
    hashed = features(folded, start, end)
    labels = label_tokens(hashed, row, marks[for_chain])
    weights, bias, switch = _train_chain(hashed, row, labels)
    model = Model(weights, bias, switch, np.zeros(4))
    for_layer = ~for_chain if len(set(marks[~for_chain])) == 2 else np.ones(len(marks), bool)
    data, offsets = column_bytes(pa.array([t for t, c in zip(texts, for_layer, strict=True) if c], pa.string()))
    row, logit = model.tokens(data, offsets)[2:]
    model.layer = _train_layer(summary(row, logit, int(for_layer.sum())), marks[for_layer], share)
    return model


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic",
        most_toxic: int = SAMPLE_TOXIC, most_clean: int = SAMPLE_CLEAN, most_bytes: int = SAMPLE_BYTES) -> Model | None:
    """Model from a bounded sample of labelled rows, the first of each class in a hash order.

    Null ids and labels are not used; an id labelled more than once is toxic if one label says so.
    Texts over ``most_bytes`` and null texts are not used, nor are labels of ids without any other; of an id with several
    texts one is used, equal texts once.  The sample's ids, at most ``most_toxic + most_clean``, are
    broadcast; the classes' shares are counted over all labels.
    """
    marked = labels.where(F.col(doc_id).isNotNull() & F.col(toxic).isNotNull()) \
        .groupBy(F.col(doc_id).alias("_id")).agg((F.max(toxic) > 0).alias("_toxic"))
    n_toxic, n_all = marked.agg(F.count_if("_toxic"), F.count("*")).first()
    order = F.xxhash64("_id")
    given = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).where(F.octet_length("text") <= most_bytes)
    marked = marked.join(given.select("_id").distinct(), "_id", "left_semi")
    picked = marked.where("_toxic").orderBy(order, "_id").limit(most_toxic) \
        .unionAll(marked.where("not _toxic").orderBy(order, "_id").limit(most_clean))
    rows = given.join(F.broadcast(picked), "_id") \
        .groupBy("_id").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("one"), F.max("_toxic").alias("_toxic")) \
        .select("_id", "one.text", "_toxic").groupBy("text").agg(F.min("_id").alias("_id"), F.max("_toxic").alias("_toxic")).collect()
    rows.sort(key=lambda r: (str(r["_id"]), r["text"]))
    return train([r["text"] for r in rows], [r["_toxic"] for r in rows], n_toxic / max(1, n_all))


def _spans(start, end, row, logit, data, offsets, n) -> list[list[dict]]:
    """Per row the runs of neighbouring words with marginal 0.5 or more, in code points."""
    out: list[list[dict]] = [[] for _ in range(n)]
    hot = np.flatnonzero(logit >= 0)
    if not len(hot):
        return out
    place = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    first = np.flatnonzero(np.r_[True, (np.diff(hot) > 1) | (row[hot][1:] != row[hot][:-1])])
    for a, b in zip(first, np.r_[first[1:], len(hot)], strict=True):
        run = hot[a:b]
        base = place[offsets[row[run[0]]]]
        out[row[run[0]]].append({"start": int(place[start[run[0]]] - base), "end": int(place[end[run[-1]]] - base),
                                 "marginal": float(sigmoid(logit[run]).max())})
    return out


def score(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score (0 to 1), spans (start, end in code points, marginal) for every row.

    Each whole text is one chain of words; forward-backward gives each word's marginal.  The
    strongest marginal and the expected number of toxic words make the document's score; neighbouring
    words of marginal 0.5 or more make a span.  Empty and null texts get the score of a text
    without toxic words and no spans; without a model every score is 0.  Repeated rows and null ids
    are scored each; no rows give no rows; other columns are not looked at.
    """
    kind = docs.select(F.col(doc_id).alias("doc_id")).schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())]))

    def run(batches):
        free()
        known = sent.value
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            scores, spans = [np.zeros(0)], []
            for a, b in chunks(offsets, CHUNK):
                part, ends = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                if known is None:
                    scores.append(np.zeros(b - a))
                    spans += [[]] * (b - a)
                    continue
                start, end, row, logit = known.tokens(part, ends)
                scores.append(known.scores(row, logit, b - a))
                spans += _spans(start, end, row, logit, part, ends, b - a)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.concatenate(scores)), pa.array(spans, span)],
                names=["doc_id", "score", "spans"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double, spans array<struct<start: int, end: int, marginal: double>>")


def drop_toxic(docs: DataFrame, model: Model | None, text: str = "text", least: float = 0.5) -> DataFrame:
    """Documents that score below ``least``, with all their columns; nothing is shuffled.  Scores as in ``score``.

    Whole rows pass through in small batches, so that the JVM keeps no queue of rows that wait for a score.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        free()
        known = sent.value
        for batch in batches:
            if known is not None:
                data, offsets = column_bytes(batch.column(text))
                clean = [np.zeros(0, bool)]
                for a, b in chunks(offsets, CHUNK):
                    *_, row, logit = known.tokens(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                    clean.append(known.scores(row, logit, b - a) < least)
                batch = batch.filter(pa.array(np.concatenate(clean)))
            yield batch

    return docs.mapInArrow(run, docs.schema)


def training_rows(rows: DataFrame, doc_id: str = "doc_id", parts: int = 5) -> DataFrame:
    """Rows that are not held out (crc32 of the id's text modulo ``parts`` is not 0)."""
    return rows.where(folds(F.col(doc_id), parts) != 0)
