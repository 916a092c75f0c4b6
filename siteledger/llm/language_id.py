"""Language identification by cross-parsing: the language whose text explains a document in the fewest phrases."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .textnum import chunks, column_bytes

# Bounds of the model: bytes of training text for each language and for all together, bytes of one text, documents of
# a language that are looked at, and languages.
TRAIN_BYTES, ALL_BYTES, TEXT_BYTES = 24_000, 384_000, 6_000
SAMPLE_DOCS = 400
MOST_LANGUAGES = 256
# Texts are parsed in segments of this many symbols, all of them; a segment's end closes a phrase.
SEGMENT = 1024
SEGMENTS_AT_ONCE = 2048
CHUNK = 2 << 20
BREAK = 0x20


def _fold_table() -> np.ndarray:
    """Bytes as symbols: A-Z lower-cased, every other ASCII byte that is no letter a break."""
    table = np.arange(256, dtype=np.uint8)
    table[:128] = BREAK
    table[97:123] = np.arange(97, 123)
    table[65:91] = np.arange(97, 123)
    return table


FOLD = _fold_table()


def fold(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of each text with runs of breaks as one, and their offsets."""
    symbols = FOLD[data]
    drop = np.zeros(len(symbols), bool)
    drop[1:] = (symbols[1:] == BREAK) & (symbols[:-1] == BREAK)
    kept = np.r_[0, np.cumsum(~drop)]
    return symbols[~drop], kept[offsets]


class Automaton:
    """Suffix automaton of a byte string; each path from state 0 spells a substring of it."""

    def __init__(self, text: bytes):
        self.next, link, length = [{}], [-1], [0]
        last = 0
        for symbol in text:
            state = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            at = last
            while at >= 0 and symbol not in self.next[at]:
                self.next[at][symbol] = state
                at = link[at]
            if at >= 0:
                to = self.next[at][symbol]
                if length[at] + 1 == length[to]:
                    link[state] = to
                else:
                    copy = len(self.next)
                    self.next.append(dict(self.next[to]))
                    length.append(length[at] + 1)
                    link.append(link[to])
                    while at >= 0 and self.next[at].get(symbol) == to:
                        self.next[at][symbol] = copy
                        at = link[at]
                    link[to] = link[state] = copy
            last = state

    def table(self, code: np.ndarray, n_codes: int) -> np.ndarray:
        """Dense transitions (state * n_codes + code); -1 where no substring goes on."""
        out = np.full((len(self.next), n_codes), -1, np.int32)
        for state, edges in enumerate(self.next):
            for symbol, to in edges.items():
                out[state, code[symbol]] = to
        return out.ravel()


class Model:
    """One automaton table per language over a common alphabet; a few MB, sent to the tasks as it is."""

    def __init__(self, texts: dict[str, list[str]]):
        folded = {}
        for lang, parts in sorted(texts.items()):
            data = np.frombuffer("\n".join(parts).encode(), np.uint8)
            symbols, _ = fold(data, np.array([0, len(data)]))
            if len(symbols):
                folded[lang] = symbols
        self.languages = list(folded)
        seen = np.unique(np.concatenate(list(folded.values()))) if folded else np.zeros(0, np.uint8)
        # The last code stands for bytes that no language has.
        self.n_codes = len(seen) + 1
        self.code = np.full(256, len(seen), np.uint8)
        self.code[seen] = np.arange(len(seen))
        self.tables = [Automaton(s.tobytes()).table(self.code, self.n_codes) for s in folded.values()]

    def phrases(self, symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Phrases (texts x languages) of the greedy longest-match parse; segments step together."""
        n = len(offsets) - 1
        out = np.zeros((n, len(self.tables)), np.int64)
        codes = self.code[symbols]
        lengths = np.diff(offsets)
        parts = -(-lengths // SEGMENT)
        row = np.repeat(np.arange(n), parts)
        start = offsets[:-1][row] + SEGMENT * (np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts))
        size = np.minimum(SEGMENT, offsets[1:][row] - start)
        order = np.argsort(-size, kind="stable")
        row, start, size = row[order], start[order], size[order]
        for a in range(0, len(row), SEGMENTS_AT_ONCE):
            first, long = start[a:a + SEGMENTS_AT_ONCE], size[a:a + SEGMENTS_AT_ONCE]
            grid = np.full((int(long[0]), len(first)), self.n_codes - 1, np.int32)
            for k in range(len(first)):
                grid[:long[k], k] = codes[first[k]:first[k] + long[k]]
            alive = np.searchsorted(-long, -np.arange(int(long[0])), side="left")
            for lang, table in enumerate(self.tables):
                found = np.zeros(len(first), np.int64)
                state = np.zeros(len(first), np.int32)
                root = np.maximum(table[:self.n_codes], 0)
                alone = (table[:self.n_codes] < 0).astype(np.int64)
                for step, m in enumerate(alive):
                    symbol, at = grid[step, :m], state[:m]
                    to = table[at * self.n_codes + symbol]
                    miss = np.flatnonzero(to < 0)
                    # A phrase ends; a symbol that the language lacks is one of its own.
                    lost = symbol[miss]
                    found[miss] += (at[miss] > 0) + alone[lost]
                    to[miss] = root[lost]
                    state[:m] = to
                np.add.at(out[:, lang], row[a:a + SEGMENTS_AT_ONCE], found + (state > 0))
        return out


def folds(doc_id: Column, parts: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def fit(labelled: DataFrame, lang: str = "lang", text: str = "text", doc_id: str = "doc_id", train_bytes: int = TRAIN_BYTES,
        sample_docs: int = SAMPLE_DOCS, most_languages: int = MOST_LANGUAGES) -> Model:
    """Model from a bounded sample: of each language the first texts in a hash order, up to ``train_bytes`` together.

    Of a text longer than TEXT_BYTES a stretch of about that size is used, from a place that its hash sets, so a language
    of long texts only is learnt too.  The ``most_languages`` most frequent languages are learnt (of equally frequent
    ones the first in order); more than ALL_BYTES / ``train_bytes`` of them share ALL_BYTES evenly.  Rows with null
    text or language or without a letter are not used, repeated rows count once.  Runs jobs.

    Languages are counted first, so that a column of any number of values is never gathered.  A language's share of
    hashes is then set from its count: about four times ``sample_docs`` rows of it are ranked, however many there are.
    """
    usable = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(text).rlike("\\p{L}")) \
        .select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(doc_id, text).alias("h"))
    counts = usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most_languages).collect()
    if not counts:
        return Model({})
    spark = labelled.sparkSession
    learnt = F.broadcast(spark.createDataFrame([(r["lang"], r["n"]) for r in counts], "lang string, n bigint"))
    share = min(train_bytes, max(1, ALL_BYTES // len(counts)))
    place = F.shiftrightunsigned("h", 11) / float(1 << 53)
    letters = F.length("text")
    begin = F.when(letters > TEXT_BYTES, F.pmod("h", letters - TEXT_BYTES + 1)).otherwise(F.lit(0)).cast("int")
    picked = usable.join(learnt, "lang").where(place * F.col("n") <= 4 * sample_docs) \
        .select("lang", "h", F.substring("text", begin + 1, F.lit(TEXT_BYTES)).alias("text")).distinct() \
        .withColumn("size", F.octet_length("text")) \
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))) \
        .where(F.col("rank") <= sample_docs) \
        .withColumn("before", F.sum("size").over(Window.partitionBy("lang").orderBy("rank")) - F.col("size")) \
        .where(F.col("before") < share).select("lang", "rank", "text")
    texts: dict[str, list[str]] = {}
    for row in sorted(picked.collect(), key=lambda r: (r["lang"], r["rank"])):
        texts.setdefault(row["lang"], []).append(row["text"])
    return Model({name: _shortened(of, share) for name, of in texts.items()})


def _shortened(texts: list[str], most: int) -> list[str]:
    """Texts up to ``most`` bytes together; the last one is cut at a letter's end."""
    out, left = [], most
    for text in texts:
        raw = text.encode()[:left]
        out.append(raw.decode(errors="ignore"))
        left -= len(raw)
    return out


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score and phrases (per 100 symbols, by language) for every row.

    Each whole text is parsed against each language's automaton: from the root as far as the
    training text has the same substring, then a new phrase.  Phrases are normalised by
    n / log2(training bytes), so that unequal samples compare; fewest wins, ties go to the
    first language in order.  score is the share by which the winner beats the runner-up (1 if
    there is none).  Null texts and texts without a letter (\\p{L}) are ``und`` with score 0, and so is
    everything under an empty model.  Repeated rows and null ids are answered each; other
    columns are not looked at.
    """
    kind = docs.select(F.col(doc_id).alias("doc_id")).schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        known = sent.value
        weights = np.array([math.log2(max(2, len(t) // known.n_codes)) for t in known.tables])
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            made = [np.zeros((0, len(known.tables)))]
            for a, b in chunks(offsets, CHUNK):
                symbols, ends = fold(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                made.append(known.phrases(symbols, ends) * weights / np.maximum(1, np.diff(ends))[:, None])
            rates = np.concatenate(made)
            letters = batch.column("letters").to_pylist()
            pred, score = [], []
            for some, rate in zip(letters, rates, strict=True):
                if not some or not len(rate):
                    pred.append("und")
                    score.append(0.0)
                    continue
                best = int(rate.argmin())
                pred.append(known.languages[best])
                other = np.delete(rate, best)
                score.append(1.0 - rate[best] / other.min() if len(other) else 1.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                 pa.array(list(rates * 100.0), pa.list_(pa.float64()))],
                names=["doc_id", "lang_pred", "score", "phrases"])

    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                        F.coalesce(F.col(text).rlike("\\p{L}"), F.lit(False)).alias("letters"))
    return given.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, phrases array<double>")
