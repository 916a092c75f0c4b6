"""Operators on documents: odd input, and results against brute force."""

import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siteledger.llm import exact_dedup, language_id, minhash_dedup, packing, sentencepiece_nbest, substring_dedup, \
    textnum, toxicity, workers
from siteledger.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def dropped(df):
    return df.select("doc_id", "text").collect()


# ---- words and shingles

def test_words_are_runs_between_ascii_white_space_and_stay_in_their_row():
    texts = ["a  bc\td", None, "", "\x0b\x0c", "é x y"]
    data, offsets = textnum.column_bytes(pa.array(texts))
    start, end, row = textnum.words(data, offsets)
    assert [(r, data[s:e].tobytes().decode()) for s, e, r in zip(start, end, row)] == [
        (0, "a"), (0, "bc"), (0, "d"), (4, "é x"), (4, "y")]


def test_shingles_equal_sets_of_word_runs():
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 9))) for _ in range(200)]
    data, offsets = textnum.column_bytes(pa.array(texts))
    start, end, row = textnum.words(data, offsets)
    value, of, _ = textnum.shingles(textnum.word_hashes(data, start, end), row, 4)
    name = {}
    for k, text in enumerate(texts):
        w = text.split()
        runs = [tuple(w[i:i + 4]) for i in range(len(w) - 3)] or ([tuple(w)] if w else [])
        mine = value[of == k].tolist()
        assert len(mine) == len(runs)
        for run, v in zip(runs, mine):
            assert name.setdefault(run, v) == v
    assert len(set(name.values())) == len(name)


# ---- exact copies

def test_exact_copies_of_odd_documents(odd_documents):
    got = {(r["doc_id"], r["digest"]): (r["keep_id"], r["group_size"])
           for r in exact_dedup.find_copies(odd_documents, counters=3).collect()}
    by_id = {k[0]: v for k, v in got.items() if k[0] is not None}
    assert by_id[1] == by_id[2] == by_id[3] == (3, 4)          # null, empty, white space, and a null id: longest stays
    assert by_id[8] == by_id[9] == (9, 3)
    assert exact_dedup.find_copies(odd_documents).count() == 16
    kept = exact_dedup.drop_copies(odd_documents, counters=3)
    assert kept.columns == odd_documents.columns
    assert sorted(r["doc_id"] for r in dropped(kept) if r["doc_id"]) == [3, 4, 5, 6, 7, 9, 10, 11, 12, 13]
    assert exact_dedup.drop_copies(odd_documents.limit(0)).count() == 0


def test_rows_repeated_with_one_id_and_text_leave_one(documents):
    kept = exact_dedup.drop_copies(documents((1, "a b"), (1, "a b"), (2, "ab"), (3, "c")))
    assert sorted(map(tuple, dropped(kept))) == [(1, "a b"), (3, "c")]


# ---- near copies

def sequential_superminhash(values, size, seed=1):
    """The published procedure, element by element, with the operator's random numbers."""
    least = [None] * size
    for x in values:
        x = np.array([x], textnum.U64) + textnum.times(seed, textnum.GOLDEN)
        place = list(range(size))
        for j in range(size):
            random_ = int(textnum.mix(x ^ textnum.times(j + 1, textnum.GOLDEN))[0])
            k = j + ((random_ & 0xFFFF) * (size - j) >> 16)
            place[j], place[k] = place[k], place[j]
            offer = j << 48 | random_ >> 16
            if least[place[j]] is None or offer < least[place[j]]:
                least[place[j]] = offer
    return least


@pytest.mark.parametrize("n", [1, 3, 40, 300])
def test_signature_equals_the_sequential_procedure(n):
    values = np.random.default_rng(n).integers(0, 2**63, n, dtype=np.uint64)
    got = minhash_dedup.superminhash(values, np.zeros(n, np.int64), 1, 24)
    assert got[0].tolist() == sequential_superminhash(values, 24)


def brute_classes(docs, width=4):
    sets = {}
    for i, text in docs:
        w = [x for x in re.split(r"[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(n, seed):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    out = []
    for i in range(n):
        w = base.copy()
        for _ in range(rng.randrange(9)):
            w[rng.randrange(150)] = f"e{rng.randrange(9000)}"
        out.append((i, " ".join(w)))
    return out


def test_a_large_group_of_near_copies_with_strays_matches_brute_force(documents, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK", 16)     # several groups for one bucket
    docs = near_copies(150, 5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash_dedup.classes(documents(*docs)).collect()}
    assert got == brute_classes(docs)
    assert len({c for _, c in got.values()}) > 1


def test_near_copies_of_odd_documents(odd_documents):
    rows = minhash_dedup.classes(odd_documents).collect()
    assert len(rows) == 16
    got = {r["doc_id"]: r for r in rows}
    assert got[1]["n_shingles"] == 0 and got[1]["component_id"] == 1
    assert got[4]["n_shingles"] == 1
    assert got[7]["component_id"] == 6 and got[9]["component_id"] == 8
    kept = minhash_dedup.drop_near_copies(odd_documents)
    assert kept.columns == odd_documents.columns
    # 12 shares most of its shingles with 11.
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"]) == [1, 2, 3, 4, 5, 6, 8, 8, 10, 11, 13]
    assert minhash_dedup.classes(odd_documents.limit(0)).count() == 0


def test_near_copies_are_told_apart_by_id_and_text(documents):
    rng = random.Random(11)
    base, other, third, fourth = ([f"{c}{rng.randrange(10**6)}" for _ in range(60)] for c in "abcd")

    def tail(words, end):
        return " ".join([*words, end])
    rows = [(1, " ".join(base)), (None, tail(base, "x")), (None, "a clean text without any id at all"),
            (None, "another clean text that has no id either"), (5, tail(base, "y")), (5, "a second text of the id five stays here"),
            (7, " ".join(other)), (7, tail(other, "x")), (7, tail(other, "y")), (None, " ".join(third)), (None, tail(third, "x")),
            (None, " ".join(fourth)), (9, tail(fourth, "x"))]
    kept = [tuple(r) for r in dropped(minhash_dedup.drop_near_copies(documents(*rows)))]
    assert len(kept) == len(set(kept)) == 7
    assert {rows[0], rows[2], rows[3], rows[5], rows[12]} <= set(kept)
    assert sum(r in kept for r in rows[6:9]) == sum(r in kept for r in rows[9:11]) == 1
    assert not {rows[1], rows[4], rows[11]} & set(kept)


# ---- repeated passages

def test_compact_windows_match_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(150):
        n, least = int(rng.integers(1, 90)), int(rng.integers(2, 12))
        value = rng.integers(0, 2**63, n).astype(np.uint64)
        row = np.sort(rng.integers(0, 3, n))
        hashed = textnum.mix(value ^ textnum.times(1, textnum.GOLDEN))
        want = []
        for c in range(n):
            left = right = c
            while left > 0 and row[left - 1] == row[c] and hashed[left - 1] > hashed[c]:
                left -= 1
            while right + 1 < n and row[right + 1] == row[c] and hashed[right + 1] > hashed[c]:
                right += 1
            if right - left + 1 >= least:
                want.append((left, c, right))
        got = substring_dedup.compact_windows(value, row, least, 0)
        assert list(zip(*[x.tolist() for x in got[:3]])) == want


def fresh(rng, n):
    return [f"u{rng.randrange(10**9)}" for _ in range(n)]


def test_passages_of_fifty_words_are_found_and_clean_documents_left_alone(documents):
    rng = random.Random(7)
    passages = [fresh(rng, 50 + 7 * k) for k in range(8)]
    docs, dirty = [], set()
    for i in range(60):
        words = fresh(rng, 120)
        if i % 3 == 0:
            words[60:60] = passages[i // 3 % 8]
            dirty.add(i)
        docs.append((i, " ".join(words)))
    frame = documents(*docs)
    kept = {r["doc_id"]: r["text"].split() for r in substring_dedup.drop_repeats(frame).collect()}
    before = {i: t.split() for i, t in docs}
    assert set(kept) == set(before)
    assert all(kept[i] == before[i] for i in before if i not in dirty)
    for p in passages:
        holders = [i for i, w in kept.items() if " ".join(p) in " ".join(w)]
        assert len(holders) == 1
    assert all(set(before[i]) - set(kept[i]) <= set().union(*passages) for i in dirty)


def test_a_passage_that_repeats_itself_is_found():
    value = np.r_[np.tile(np.arange(30), 5), np.arange(100, 112)].astype(textnum.U64)
    assert substring_dedup.near_passages(value, value, 46, 80) == [(0, 161, 0, 161)]


def test_passages_are_found_whatever_the_hub_of_their_windows(documents, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BLOCK", 7)     # several pieces for one group
    rng = random.Random(13)
    passages = [fresh(rng, 60) for _ in range(4)]
    phrases = [[p[k:k + 5] for k in range(0, 56, 5)] for p in passages]
    docs = []
    for i in range(30):
        # Texts that share phrases of a passage only; some of them are the first of each phrase's windows.
        docs.append((i, " ".join(x for p in phrases for phrase in p for x in [*fresh(rng, 45), *phrase])))
    docs += [(100 + i, " ".join([*fresh(rng, 80), *passages[i % 4], *fresh(rng, 80)])) for i in range(12)]
    # The second place of a phrase is the one with the passage.
    docs += [(200, " ".join([*fresh(rng, 60), *passages[0][20:30], *fresh(rng, 60), *passages[0]]))]
    kept = {r["doc_id"]: r["text"].split() for r in substring_dedup.drop_repeats(documents(*docs)).collect()}
    assert all(kept[i] == t.split() for i, t in docs[:30])
    for p in passages:
        for k in range(11):
            assert sum(" ".join(p[k:k + 50]) in " ".join(w) for w in kept.values()) == 1


def test_repeats_of_odd_documents(odd_documents):
    kept = substring_dedup.drop_repeats(odd_documents)
    assert kept.columns == odd_documents.columns
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert texts[1] is None and texts[2] == "" and texts[13] == "B" * 5000
    assert sum("p5 p6" in t for t in texts.values() if t) == 1
    assert substring_dedup.repeats(odd_documents.limit(0)).count() == 0


# ---- packing

def check_packing(docs, pieces, capacity=2048):
    tokenizer = packing.encoder("word_bpe_49k.json").whole
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
    for i, text in docs:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4").tobytes()
        mine = sorted(by_doc[i], key=lambda p: p["start"])
        assert b"".join(p["ids"] for p in mine) == ids
        assert [p["start"] for p in mine] == list(itertools.accumulate([0] + [p["length"] for p in mine]))[:-1]
        assert {p["doc_tokens"] for p in mine} == {len(ids) // 4}
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    padding = 0
    for mine in by_sequence.values():
        mine.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in mine] == list(itertools.accumulate([0] + [p["length"] for p in mine]))[:-1]
        n = sum(p["length"] for p in mine)
        assert n <= capacity
        padding += 0 if n & (n - 1) == 0 else capacity - n
    return padding


def test_packing_is_gapless_and_whole(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pieces = packing.pack(docs).collect()
    assert check_packing([(r["doc_id"], r["text"]) for r in docs.collect()], pieces) == 0


def test_packing_of_odd_documents(documents, odd_documents):
    rows = packing.pack(odd_documents.coalesce(1), buffer_tokens=5000).collect()
    assert {r["doc_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    docs = [(i, t) for i, t in odd_documents.select("doc_id", "text").collect() if i not in (None, 8)]
    check_packing(docs, [r for r in packing.pack(documents(*docs)).collect()])
    assert packing.pack(odd_documents.limit(0)).count() == 0


def test_word_ids_equal_those_of_the_whole_text():
    texts = ["It's  the don't we'll", "ABC ÀÉ ß²½ 12'3", "a b\x85c", "ﬁ İ ẞ", "\x1f x", "''s 'S", "漢字 と"]
    made = packing.Encoder("word_bpe_49k.json")
    for text, ids in zip(texts, made.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == made.whole.encode(text, add_special_tokens=False).ids


def test_added_tokens_in_a_text_keep_their_ids():
    made = packing.Encoder("word_bpe_49k.json")
    texts = ["one <|endoftext|> two", "<|startoftext|>one", "<|ENDOFTEXT|>x", "a<|endoftext|><|endoftext|>", "<| endoftext |>", "plain"]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in made.encode(texts)]
    assert got == [made.whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert made.whole.token_to_id("<|endoftext|>") in got[0]


def test_assignment_takes_the_cheapest_sequence_with_room():
    pieces = packing.assign([5, 4, 3, 3, 1], capacity=8)
    loads = {}
    for _, _, n, s, _ in pieces:
        loads[s] = loads.get(s, 0) + n
    assert sorted(loads.values()) == [8, 8] and sum(loads.values()) == 16


# ---- language

def test_automaton_has_exactly_the_substrings():
    text = b"abcbcabca"
    automaton = language_id.Automaton(text)
    subs = {text[i:j] for i in range(len(text)) for j in range(i + 1, len(text) + 1)}
    for n in range(1, 5):
        for word in itertools.product(b"abc", repeat=n):
            at = 0
            for symbol in word:
                at = automaton.next[at].get(symbol, -1)
                if at < 0:
                    break
            assert (at >= 0) == (bytes(word) in subs)


def test_phrases_are_greedy_longest_matches():
    model = language_id.Model({"x": ["the cat sat on the mat"], "y": ["el gato se sienta"]})
    texts = ["the mat sat", "gatos", "", "zzz el cat"]
    data, offsets = textnum.column_bytes(pa.array(texts))
    symbols, ends = language_id.fold(data, offsets)
    got = model.phrases(symbols, ends)
    for k, text in enumerate(texts):
        for lang, known in enumerate(["the cat sat on the mat", "el gato se sienta"]):
            at, n = 0, 0
            while at < len(text):
                size = 1
                while at + size <= len(text) and text[at:at + size] in known:
                    size += 1
                at += max(1, size - 1)
                n += 1
            assert got[k, lang] == n


def test_language_of_held_out_documents(spark):
    got = QUERIES["op2_language_id"](spark, SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    right = got.where("held_out and lang_pred <> 'und'").join(truth, "doc_id")
    assert right.where("lang = lang_pred").count() >= 0.98 * right.count() > 0
    assert got.where((F.col("score") < 0) | (F.col("score") > 1)).count() == 0


def test_language_of_odd_documents(odd_documents):
    model = language_id.fit(odd_documents)
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(odd_documents, model).collect()}
    assert got[1] == got[2] == got[3] == "und" and got[4] == "en"
    empty = language_id.fit(odd_documents.limit(0))
    assert {r["lang_pred"] for r in language_id.identify(odd_documents, empty).collect()} == {"und"}
    assert language_id.identify(odd_documents.limit(0), model).count() == 0


# ---- toxicity

def test_marginals_match_enumeration():
    rng = np.random.default_rng(3)
    switch = np.array([0.0, -0.7, 0.4, 0.9])
    lengths = np.array([1, 4, 6])
    begin = np.cumsum(lengths) - lengths
    emission = rng.normal(size=lengths.sum())
    logit = toxicity.chain(emission, begin, lengths, switch)[2]
    for b, n in zip(begin, lengths):
        total, hot = 0.0, np.zeros(n)
        for path in itertools.product((0, 1), repeat=int(n)):
            score = sum(emission[b + i] for i in range(n) if path[i]) \
                + sum(switch[2 * path[i - 1] + path[i]] for i in range(1, n))
            total += np.exp(score)
            hot += np.exp(score) * np.array(path)
        assert np.allclose(toxicity.sigmoid(logit[b:b + n]), hot / total)


def test_toxicity_of_held_out_documents(spark):
    got = QUERIES["op1_toxicity"](spark, "/root/testdata/sf0.1")
    truth = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = got.where("held_out").join(truth, "doc_id").select("predicted", "toxic", "score").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in held]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in held)
    fold_of = {r["doc_id"]: r["held_out"] for r in got.select("doc_id", "held_out").limit(50).collect()}
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in fold_of.items())


def test_spans_point_at_the_offending_words(documents, spark):
    rng = random.Random(4)
    docs = [(i, " ".join(fresh(rng, 20) + (["é", "dolt,", "xyz"] if i % 2 else ["é", "good,", "xyz"]))) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (3, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(documents(*docs), labels)
    rows = {r["doc_id"]: r for r in toxicity.score(documents(*docs, (900, None), (901, "")), model).collect()}
    assert rows[900]["score"] == rows[901]["score"] < 0.5 and rows[900]["spans"] == []
    for i, text in docs:
        found = [text[s["start"]:s["end"]] for s in rows[i]["spans"]]
        assert found == (["dolt"] if i % 2 else [])
        assert (rows[i]["score"] >= 0.5) == bool(i % 2)
    assert toxicity.drop_toxic(documents(*docs), model).count() == 100


def test_toxicity_of_odd_documents(odd_documents, spark):
    none = toxicity.fit(odd_documents, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert none is None
    assert {r["score"] for r in toxicity.score(odd_documents, none).collect()} == {0.0}
    assert toxicity.drop_toxic(odd_documents, none).columns == odd_documents.columns
    assert toxicity.score(odd_documents.limit(0), none).count() == 0


# ---- pieces

def all_segmentations(pieces, text):
    out = []

    def go(i, ids, score):
        if i == len(text):
            out.append((score, ids))
            return
        if text[i] not in pieces.ids:
            raw = text[i].encode()
            go(i + 1, ids + tuple(pieces.byte_ids[b] for b in raw), score + pieces.byte_score * len(raw))
        for j in range(i + 1, len(text) + 1):
            if text[i:j] in pieces.ids:
                found = pieces.ids[text[i:j]]
                go(j, ids + (found,), score + pieces.scores[found])
    go(0, (), 0.0)
    return sorted(out, key=lambda d: (-d[0], d[1]))


def test_best_segmentations_match_enumeration():
    made = sentencepiece_nbest.Encoder("piece_bpe_32k.model", 4)
    for chunk in (" thent", " hello", "   x", " 漢a", " été", " aaaa"):
        want = all_segmentations(made.pieces, chunk)
        got = made.pieces.best(chunk, 5)
        assert [s for s, _ in got] == [s for s, _ in want[:5]] and set(got) <= set(want) and len(set(got)) == len(got)
        near = [s for s, _ in want if s >= want[0][0] - 5000][:5]
        assert [s for s, _ in made.pieces.best(chunk, 5, 5000.0)] == near
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice("the cat, é1.!\n  x²漢") for _ in range(rng.randint(1, 7)))
        want = all_segmentations(made.pieces, " " + text)[:4]
        assert [s for s, _ in made.encode(text)] == [s for s, _ in want]


def test_packing_lets_go_of_its_words_after_a_task_when_told(spark, odd_documents):
    docs, words = odd_documents.where("doc_id is not null").select("doc_id", "text").distinct().repartition(4, "doc_id"), 77_777
    key = ["doc_id", "start", "ids", "sequence_id", "offset"]

    def holding(batches):
        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([sum(words in name for name in workers._held)], pa.int32())})

    def packed(**how):
        rows = packing.pack(docs, cache_words=words, **how).select(*key).collect()
        return rows, sum(r["n"] for r in spark.range(0, 64, 1, 16).mapInArrow(holding, "n int").collect())

    kept, n = packed()
    assert n > 0
    released, n = packed(release=True)
    assert sorted(released, key=str) == sorted(kept, key=str)
    assert n == 0
    small = packing.Encoder("word_bpe_49k.json", 3)
    assert list(small.encode(["a b c d", "a b"])) == list(packing.Encoder("word_bpe_49k.json").encode(["a b c d", "a b"]))


def test_new_chunks_are_searched_together_and_few_again(monkeypatch):
    made = sentencepiece_nbest.Encoder("piece_bpe_32k.model", 3)
    rng, single = random.Random(5), made.pieces.best
    chunks = [" " + "".join(rng.choice("etaoinshrdluéB漢\U00012000 .\n\t") for _ in range(rng.randint(1, 12))) for _ in range(500)]
    chunks += [" " + "the" * 40, " ", "B" * 9]
    found = made.pieces.best_of_many(chunks)
    assert sum(f is not None for f in found) > 200
    for chunk, some in zip(chunks, found, strict=True):
        ranked = single(chunk, 2)
        if some is not None:
            ids, loss, score = some
            assert (np.frombuffer(ids, "<i4").tolist(), score) == (list(ranked[0][1]), ranked[0][0])
            assert loss == (ranked[0][0] - ranked[1][0] if len(ranked) > 1 else math.inf)
    calls = []
    monkeypatch.setattr(made.pieces, "best", lambda *a: calls.append(a) or single(*a))
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(9)) for _ in range(4000)]
    texts = [" ".join(words[k:k + 400]) for k in range(0, 4000, 400)] + [None, "", "x", "漢字 𒀀"]
    together = list(made.encode_all(texts))
    assert len(calls) < 400
    fresh = sentencepiece_nbest.Encoder("piece_bpe_32k.model", 3)
    assert together == [fresh.encode(text) for text in texts]


def test_decode_spreads_odd_ids(spark):
    rows = [(0, None), (1, []), (2, [5]), (3, [260, 3, 200]), (4, [200, 201] * 3), (5, None)]
    encoded = spark.createDataFrame(rows, "k int, ids array<int>").coalesce(1)
    shown = sentencepiece_nbest.Pieces("piece_bpe_32k.model").shown
    for row in sentencepiece_nbest.decode(encoded).collect():
        raw = None if row["ids"] is None else b"".join(shown[i] for i in row["ids"])
        assert row["text"] == (None if raw is None else (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace"))


def test_a_long_run_of_one_letter_has_ties_without_end():
    made = sentencepiece_nbest.Encoder("piece_bpe_32k.model", 3)
    assert len({ids for _, ids in made.encode("B" * 20_000)}) == 3


def test_texts_come_back_whole(spark, odd_documents):
    for docs in (odd_documents, spark.read.parquet(f"{SF}/documents.parquet")):
        decoded = sentencepiece_nbest.decode(sentencepiece_nbest.encode(docs)).select("doc_id", "rank", F.col("text").alias("back"))
        texts = {r["doc_id"]: r["text"] or "" for r in docs.where("doc_id is not null").select("doc_id", "text").collect()}
        rows = decoded.where("doc_id is not null").collect()
        assert rows and all(r["back"] == texts[r["doc_id"]] for r in rows)
        assert {r["doc_id"] for r in rows} == set(texts)
    assert sentencepiece_nbest.encode(odd_documents.limit(0)).count() == 0
