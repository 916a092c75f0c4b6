"""Cases that only large or dirty tables have: clashing names, many repeated rows, clustered vectors, odd samples."""

import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from siteledger.llm import chat_format, embedding_dedup, language_id, minhash_dedup, queries, substring_dedup, toxicity


def fresh(rng, n):
    return [f"u{rng.randrange(10**9)}" for _ in range(n)]


# ---- near copies

def test_what_an_explode_makes_is_not_broadcast(spark):
    """Spark sizes a list's rows as if they were one, so by these sizes a table of 40 bands a node would go to the driver."""
    nodes = spark.range(0, 500, 1, 4).select("id", F.sequence(F.lit(0), F.lit(39)).alias("bands"))
    shared = minhash_dedup._shared_buckets(nodes.select(F.explode("bands").alias("bucket"), "id"))
    opened = shared.select("bucket", "id", F.col("id").alias("root"), (F.col("id") == 1).alias("main"),
                           F.lit(499).alias("members"), F.lit(498).alias("minor"))
    marks = spark.range(500).select("id", F.lit(bytes(240)).alias("slots"))
    pairs = minhash_dedup._other_pairs(opened, marks, marks.select("id", F.lit(bytes(8)).alias("items")), 80, 40, 6)
    for frame, measured in ((shared, 0), (pairs, 1)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") == measured
    assert shared.where("hub = 0").count() == 40 * 500


# ---- repeated passages

def test_many_repeated_rows_are_one_text(documents):
    rng = random.Random(1)
    text = " ".join(fresh(rng, 60))
    other = " ".join([*fresh(rng, 30), *text.split(), *fresh(rng, 30)])
    rows = [(None, text)] * 2500 + [(5, text)] * 2500 + [(6, other)]
    found = substring_dedup.repeats(documents(*rows)).collect()
    assert len(found) == 2 and len({(r["th"], r["start"], r["end"]) for r in found}) == 2
    kept = substring_dedup.drop_repeats(documents(*rows)).collect()
    holders = [r for r in kept if text in r["text"]]
    assert len({(r["doc_id"], r["text"]) for r in holders}) == 1
    assert len(kept) in (2501, 5001)


def test_texts_of_one_hash_stay_apart(documents, monkeypatch):
    rng = random.Random(2)
    passage = fresh(rng, 70)
    rows = [(i, " ".join([*fresh(rng, 40 * i), *passage, *fresh(rng, 25)])) for i in range(4)] + [(9, " ".join(fresh(rng, 12)))]
    want = sorted((r["doc_id"], r["text"]) for r in substring_dedup.drop_repeats(documents(*rows)).collect())
    monkeypatch.setattr(substring_dedup, "_name", lambda doc_id, text: F.lit(7).cast("bigint") + 0 * F.length(text))
    got = [(r["doc_id"], r["text"]) for r in substring_dedup.drop_repeats(documents(*rows)).collect()]
    assert len(want) == len(got) == 5
    assert sum(" ".join(passage) in t for _, t in got) == sum(" ".join(passage) in t for _, t in want) == 1
    for i, text in rows:
        mine = next(t for j, t in got if i == j).split()
        assert mine in (text.split(), [w for w in text.split() if w not in passage])


def test_near_passages_are_found(documents):
    """900 pairs of passages with one or two edited words, similarity 0.8 or more: all are found."""
    rng = random.Random(3)
    rows, pairs = [], []
    for k in range(900):
        size, edits = rng.choice([60, 80, 100]), rng.choice([1, 2])
        one = fresh(rng, size)
        two = list(one)
        for at in rng.sample(range(size), edits):
            two[at] = fresh(rng, 1)[0]
        a, b = ({tuple(x[i:i + 5]) for i in range(size - 4)} for x in (one, two))
        if 100 * len(a & b) < 80 * len(a | b):
            continue
        pairs.append((2 * k, 2 * k + 1))
        rows += [(2 * k, " ".join([*fresh(rng, 30), *one, *fresh(rng, 30)])),
                 (2 * k + 1, " ".join([*fresh(rng, 30), *two, *fresh(rng, 30)]))]
    docs = documents(*rows)
    ids = {r["th"]: r["doc_id"] for r in docs.select(substring_dedup.names(docs)[0].alias("th"), "doc_id").collect()}
    found = {tuple(sorted((ids[r["th"]], ids[r["other_th"]]))) for r in substring_dedup.repeats(docs).collect()}
    assert len(pairs) > 600
    assert len(found & set(pairs)) >= 0.99 * len(pairs)
    assert found <= set(pairs)


def test_links_of_a_settled_passage_are_found(documents):
    """Two passages differ by an edit from a third each and by both edits, so below 0.8, from each other."""
    rng = random.Random(5)
    rows, pairs = [], set()
    for k in range(300):
        middle = fresh(rng, 60)
        for j, at in enumerate((None, rng.randrange(20, 25), rng.randrange(36, 41))):
            mine = list(middle)
            if at is not None:
                mine[at] = fresh(rng, 1)[0]
            rows.append((3 * k + j, " ".join([*fresh(rng, 30), *mine, *fresh(rng, 30)])))
        pairs |= {(3 * k, 3 * k + 1), (3 * k, 3 * k + 2)}
    docs = documents(*rows)
    ids = {r["th"]: r["doc_id"] for r in docs.select(substring_dedup.names(docs)[0].alias("th"), "doc_id").collect()}
    found = {tuple(sorted((ids[r["th"]], ids[r["other_th"]]))) for r in substring_dedup.repeats(docs).collect()}
    assert len(found & pairs) >= 0.96 * len(pairs)
    assert found <= pairs


def test_passages_are_moved_as_words_and_never_written(documents, monkeypatch):
    """What is written between the steps are places and hashes; links and cuts come from words that go to their piece once."""
    rng = random.Random(8)
    passages = [fresh(rng, 300) for _ in range(6)]
    rows = [(i, " ".join([*fresh(rng, 20), *passages[i % 6], *fresh(rng, 20)])) for i in range(150)]
    written, keep = {}, substring_dedup.keep

    def recorded(df, label):
        out = keep(df, label)
        size = sum(os.path.getsize(f.removeprefix("file://").removeprefix("file:")) for f in out.inputFiles())
        written[label] = max(written.get(label, 0), size)
        assert "binary" not in {kind for _, kind in out.dtypes} and "array<binary>" not in {kind for _, kind in out.dtypes}, label
        return out

    monkeypatch.setattr(substring_dedup, "keep", recorded)
    docs = documents(*rows)
    found = {r["th"] for r in substring_dedup.repeats(docs).collect()}
    assert len(found) == 144
    assert max(size for label, size in written.items() if label != "windows") < sum(len(t) for _, t in rows) / 4
    kept = [r["text"] for r in substring_dedup.drop_repeats(docs).collect()]
    assert all(sum(" ".join(p) in t for t in kept) == 1 for p in passages)


def test_windows_that_make_no_group_make_no_pairs(documents, monkeypatch):
    """Copies of one passage lead to one place: no window is left for pairs, nor are rows named twice."""
    rng = random.Random(11)
    passage = fresh(rng, 70)
    docs = documents(*[(i, " ".join([*fresh(rng, 30 + i), *passage, *fresh(rng, 30)])) for i in range(6)])
    rows, real = {}, substring_dedup.keep

    def keep(df, label):
        kept = real(df, label)
        rows.setdefault(label, []).append(kept.count())
        return kept

    monkeypatch.setattr(substring_dedup, "keep", keep)
    monkeypatch.setattr(queries, "table", lambda spark, sf_dir, name: docs)
    found = queries.op8_substring_dedup(docs.sparkSession, "").collect()
    assert len(found) == 5 and all(r["end"] - r["start"] >= 70 for r in found)
    assert rows["shared-windows"][0] >= 24 and rows["window-pairs"] == rows["chain-pairs"] == [0]
    assert len(rows["names"]) == 1


def test_near_passages_equal_those_of_every_run_compared():
    """By sums that settle most pairs, and without them; texts repeat themselves and each other, with edits."""
    rng = np.random.default_rng(12)

    def every_run(a, b, least, percent):
        place = {}
        for j, v in enumerate(b.tolist()):
            place.setdefault(v, j)
        hit = [i for i, v in enumerate(a.tolist()) if v in place]
        first = [place[int(a[i])] for i in hit]
        both = [first]
        if len(place) < len(b):
            both.append(substring_dedup._aligned(a, b, np.array(hit, int), np.array(first, int)).tolist())
        found = []
        cuts = [0, *[k for k in range(1, len(hit)) if hit[k] - hit[k - 1] > substring_dedup.GAP + 1], len(hit)]
        open_ = list(zip(cuts, cuts[1:]))
        while open_:
            s, e = open_.pop()
            if s == e or hit[e - 1] - hit[s] + 1 < least:
                continue
            own = set(a[hit[s]:hit[e - 1] + 1].tolist())
            for places in both:
                shift = int(np.median([places[k] - hit[k] for k in range(s, e)]))
                low, high = max(0, hit[s] + shift - substring_dedup.GAP), min(len(b) - 1, hit[e - 1] + shift + substring_dedup.GAP)
                near = [j for j in range(low, high + 1) if b[j] in own]
                if near and 100 * len(own & (other := set(b[near[0]:near[-1] + 1].tolist()))) >= percent * len(own | other):
                    found.append((hit[s], hit[e - 1], near[0], near[-1]))
                    break
            else:
                gaps = [hit[k] - hit[k - 1] for k in range(s + 1, e)]
                if gaps:
                    widest = s + 1 + gaps.index(max(gaps))
                    open_ += [(s, widest), (widest, e)]
        return found

    some = 0
    for k in range(400):
        words_of = int(rng.choice([30, 400, 10**6]))
        a = rng.integers(0, words_of, int(rng.integers(1, 90))).astype(np.uint64)
        b = np.concatenate([rng.integers(0, words_of, int(rng.integers(0, 9))).astype(np.uint64), a[rng.random(len(a)) < rng.choice([0.8, 0.95, 1])]])
        edits = rng.random(len(b)) < rng.choice([0, 0.05, 0.2])
        b[edits] = rng.integers(0, 10**9, int(edits.sum()))
        least, percent = int(rng.choice([1, 5, 20])), int(rng.choice([50, 80, 100]))
        want = every_run(a, b, least, percent)
        some += bool(want)
        assert substring_dedup.near_passages(a, b, least, percent) == want
        if len(b):
            facts = substring_dedup._first_there(a), b.argsort(kind="stable")
            assert substring_dedup.near_passages(a, b, least, percent, *facts) == want
    assert 100 < some < 390


def test_passages_of_an_area_and_their_likeness():
    """Areas of short, long, odd and empty-ended texts: words as they stand there, equal hashes for equal shingles only."""
    rng = random.Random(9)
    words = fresh(rng, 400)
    texts = ["  " + " \t".join(words), "\u00fc \u00df " + " ".join(words[100:300]).upper() + " \n", "a b c d e"]
    areas = [[(100, 250, 1), (0, 395, 2), (100, 250, 3), (3, 3, 4)], [(2, 152, 5), (0, 0, 6)], [(0, 0, 7)]]
    kind = pa.list_(pa.struct([("x", pa.int64()), ("y", pa.int64()), ("p", pa.int64())]))
    wanted = pa.array([[dict(zip("xyp", a)) for a in of] for of in areas], kind)
    batch = pa.RecordBatch.from_arrays([pa.array([11, 12, 13]), pa.array(texts), wanted], ["th", "text", "wanted"])
    rows = pa.Table.from_batches(list(substring_dedup._pasted(["x", "y", "p"])([batch]))).to_pylist()
    assert [(r["th"], r["x"], r["y"], r["p"]) for r in rows] == [(11 + k, *a) for k, of in enumerate(areas) for a in of]
    for r in rows:
        assert r["words"].decode().split() == texts[r["th"] - 11].split()[r["x"]:r["y"] + 5]
    same = [v for of in substring_dedup._likeness().func(batch.column("text"), wanted).to_pylist() for v in of]
    assert same[0] == same[2] == same[4] and len(set(same)) == 5


# ---- vectors

def test_rounds_go_on_until_clustered_vectors_are_united(spark):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal((3, 32))
    points = centre[rng.integers(0, 3, 1500)] + 0.42 * rng.standard_normal((1500, 32))
    twins = points[:300] + 0.12 * np.linalg.norm(points[:300], axis=1, keepdims=True) * rng.standard_normal((300, 32)) / np.sqrt(32) * 2.5
    found = np.concatenate([points, twins])
    unit = found / np.linalg.norm(found, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.93
    np.fill_diagonal(linked, False)
    vectors = spark.createDataFrame([(i, "a", v.tolist()) for i, v in enumerate(found)], "vec_id bigint, label string, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.link(vectors, passes=16, window=8).collect()}
    root = list(range(len(found)))
    for i, j in zip(*np.nonzero(linked)):
        a, b = i, j
        while root[a] != a:
            a = root[a]
        while root[b] != b:
            b = root[b]
        root[max(a, b)] = min(a, b)

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    wrong = [i for i in range(len(found)) if got[i] != (int(linked[i].sum()), top(i))]
    assert linked.sum() > 100
    assert len(wrong) <= 0.002 * linked.any(axis=1).sum()


# ---- samples

def test_seventy_languages_are_learnt(spark):
    rng = random.Random(5)
    words = {f"l{i:02d}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(25)] for i in range(70)}
    rows = [(k, lang, " ".join(rng.choices(words[lang], k=60))) for lang in words for k in range(4)]
    docs = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)], "doc_id bigint, lang string, text string")
    model = language_id.fit(docs.where("doc_id % 4 > 0"))
    assert len(model.languages) == 70
    got = language_id.identify(docs, model).join(docs, "doc_id").where("doc_id % 4 = 0").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) >= 68
    assert len(language_id.fit(docs, most_languages=3).languages) == 3


def test_a_language_of_long_texts_only_is_learnt(spark):
    rng = random.Random(6)
    rows = [(i, "es", " ".join(rng.choices(["hola", "que", "tal", "señor", "mañana", "ciudad"], k=9000))) for i in range(20)]
    rows += [(100 + i, "en", " ".join(rng.choices(["the", "quick", "brown", "fox", "jumps", "over"], k=20))) for i in range(20)]
    rows += [(200, "xx", "12345 6789"), (201, None, "no language"), (202, "en", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    model = language_id.fit(docs)
    assert model.languages == ["en", "es"]
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(docs, model).collect()}
    assert all(got[i] == lang for i, lang, _ in rows[:40])


def test_labels_without_a_usable_text_do_not_use_up_the_sample(spark, documents):
    rng = random.Random(7)
    bad, good = [f"vile{i}" for i in range(12)], [f"word{i}" for i in range(300)]

    def text(toxic):
        return " ".join(rng.choices(good, k=40) + (rng.choices(bad, k=6) if toxic else []))

    rows = [(i, text(i % 3 == 0)) for i in range(600)]
    labels = [(i, int(i % 3 == 0)) for i in range(600)] + [(10_000 + i, 1) for i in range(5000)] + [(20_000 + i, 0) for i in range(5000)]
    docs, marks = documents(*rows), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.fit(docs, marks, most_toxic=100, most_clean=150)
    assert model is not None
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert sum((got[i] >= 0.5) == (i % 3 == 0) for i in range(600)) >= 570
    many = documents(*[(1, f"vile1 {i}") for i in range(3000)], *rows)
    assert toxicity.fit(many, marks, most_toxic=100, most_clean=150) is not None


# ---- conversations, pipeline

def test_rows_of_one_turn_have_one_order(spark):
    rows = [(1, 1, "user", "b"), (1, 1, "user", "a"), (1, 1, "tool", "a"), (1, 2, "user", "c"), (2, 1, "user", "a"), (2, 1, "tool", "a"),
            (2, 1, "user", "b")]
    for order in (rows, rows[::-1]):
        frame = spark.createDataFrame(order, "conv_id bigint, turn int, role string, text string").repartition(3)
        got = chat_format.render(frame).collect()
        assert [(r["conv_id"], r["n_turns"]) for r in got] == [(1, 4)]
    assert len({r["rendered"] for r in got}) == 1


@pytest.mark.parametrize("rows", ["odd", "empty", "one"])
def test_pipeline_on_odd_tables(spark, odd_documents, documents, tmp_path, rows):
    docs = {"odd": odd_documents, "empty": odd_documents.limit(0), "one": documents((4, None))}[rows]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(6, None, 1), (8, 1, 0), (None, 1, 1), (99, 0, None)], "doc_id bigint, quality int, toxic int") \
        .write.parquet(f"{tmp_path}/labels.parquet")
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.keep(stage(spark, kept, str(tmp_path)), "odd")
        assert out.columns == docs.columns, name
        kept = out
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    expected = {"empty": 0, "one": 1}.get(rows)
    if expected is not None:
        assert len({r["doc_id"] for r in packed}) == expected
        return
    ids = [r["doc_id"] for r in kept.collect()]
    # Equal and near copies leave one, null and empty texts one of each kind of nothing, a repeated row one.
    assert ids.count(8) + ids.count(9) == 1 and ids.count(6) + ids.count(7) == 1 and ids.count(None) >= 1
    assert {5, 10, 13, 4} <= set(ids)
    assert {r["doc_id"] for r in packed} == set(ids)
