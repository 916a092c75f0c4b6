"""Operators on vectors, conversations and urls."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siteledger.llm import bloom, chat_format, embedding_dedup, url_filters
from siteledger.llm.common import components, keep

RULES = (("allow", "org", "/"), ("block", "example.org", "/en/1"), ("block", "com", "/de/"))


# ---- components

@pytest.mark.parametrize("n, m", [(60, 40), (200, 150), (40, 39)])
def test_components_match_a_walk(spark, n, m):
    rng = random.Random(n)
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] if m != n - 1 else [(i, i + 1) for i in range(m)]
    near = {i: {i} for i in range(n)}
    for _ in range(n):
        for a, b in edges:
            near[a] = near[b] = near[a] | near[b] if near[a] is not near[b] else near[a]
            for k in near[a]:
                near[k] = near[a]
    want = {k: min(s) for k, s in near.items() if len(s) > 1}
    frame = spark.createDataFrame([*edges, (None, 3), (5, 5), edges[0]], "a bigint, b bigint").repartition(5)
    got = {r["node"]: r["root"] for r in components(frame).collect()}
    assert {k: got.get(k, k) for k in want} == want
    assert components(frame.limit(0)).count() == 0


# ---- vectors

def brute_links(vectors):
    out = {}
    for i, v, label in vectors:
        mine = []
        for j, w, other in vectors:
            if i != j and label is not None and label == other and usable(v) and usable(w) and len(v) == len(w):
                a, b = np.array(v, float), np.array(w, float)
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.93:
                    mine.append(j)
        out[i] = mine
    return out


def usable(v):
    return v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and any(v)


def reach(links):
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            todo += [k for k in links[todo.pop()] if k not in seen and not seen.add(k)]
        out[i] = min(seen)
    return out


def test_vectors_in_clusters_larger_than_the_window(spark):
    rng = np.random.default_rng(0)
    vectors = []
    for k in range(6):
        centre = rng.normal(size=16)
        vectors += [(centre + rng.normal(size=16) * rng.uniform(0, 0.25)).tolist() for _ in range(50)]
    vectors += [vectors[0]] * 40
    rows = [(i, v, i % 2 if i < 300 else 0) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(4)
    links = brute_links(rows)
    got = {r["vec_id"]: (r["n_links"], r["component_id"])
           for r in embedding_dedup.link(frame, window=8, block=64, passes=24).collect()}
    roots = reach(links)
    assert got == {i: (len(links[i]), roots[i]) for i in links}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.1], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1),
            (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [1e-300, 0.0], 1), (11, [1.0, 0.0, 0.0], 1),
            (2, [1.0, 0.1], 1), (None, [1.0, 0.0], 1), (12, [], 1), (13, [1e200, 1e199], 1)]
    frame = spark.createDataFrame([(*r, "x", "x") for r in rows],
                                  "vec_id bigint, embedding array<double>, label int, id string, root string")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_dedup.link(frame).collect()),
                 key=lambda r: (r[0] is not None, r))
    linked = {1, 2, 10, 13}
    assert len(got) == len(rows)
    for i, n, c in got:
        assert (n, c) == ((5, 1) if i in linked or i is None else (0, i))
    assert embedding_dedup.link(frame.limit(0)).count() == 0


# ---- conversations

def test_only_maximal_conversations_are_rendered(spark, monkeypatch):
    rng = random.Random(3)
    convs = {}
    for i in range(120):
        if i > 5 and rng.random() < 0.6:
            turns = list(convs[rng.randrange(i)])[:rng.randint(1, 6)] + [(rng.choice("ua"), rng.choice("xyz"))] * rng.randint(0, 2)
        else:
            turns = [(rng.choice("ua"), rng.choice("xyz")) for _ in range(rng.randint(1, 6))]
        convs[i] = turns
    rows = [(i, t, r, x, "n", "n") for i, turns in convs.items() for t, (r, x) in enumerate(turns)]
    frame = spark.createDataFrame(rows + rows[:3], "conv_id bigint, turn bigint, role string, text string, place string, n string")
    got = {r["conv_id"]: (r["rendered"], r["n_equal"]) for r in chat_format.render(frame.repartition(6)).collect()}
    want = {}
    for i, turns in convs.items():
        longer = any(len(o) > len(turns) and o[:len(turns)] == turns for o in convs.values())
        equal = [j for j, o in convs.items() if o == turns]
        if not longer and min(equal) == i:
            want[i] = ("".join(f"<|{r}|>\n{x}<|end|>\n" for r, x in turns), len(equal))
    assert got == want


def test_a_long_conversation_spans_partitions_and_parts(spark):
    rows = [(1, t, "user", f"t{t}") for t in range(500)] + [(2, t, "user", f"t{t}") for t in range(300)] \
        + [(3, None, None, None), (None, 1, "user", "lost"), (4, 1, "", "")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(7)
    parts = chat_format.render(frame, turns_per_part=200).orderBy("conv_id", "part").collect()
    assert [(r["conv_id"], r["part"], r["n_turns"]) for r in parts] == [(1, 0, 200), (1, 1, 200), (1, 2, 100), (3, 0, 1)]
    assert "".join(r["rendered"] for r in parts[:3]) == "".join(f"<|user|>\nt{t}<|end|>\n" for t in range(500))
    assert chat_format.render(frame.limit(0)).count() == 0


# ---- urls

def brute_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [rest.find(c) for c in "/?#" if c in rest]
    host = rest[:min(ends)] if ends else rest
    tail = rest[len(host):]
    ends = [tail.find(c) for c in "?#" if c in tail]
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return lower, tail[:min(ends)] if ends else tail


def brute_rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_urls_by_rules_and_list(spark):
    urls = [None, "", "no scheme", "HTTP://A.Example.ORG/en/12?x#y", "http://example.org", "https://x.com/de/1", "https://x.com/fr",
            "http://notorg/", "a://b://c/d", "http://É.com/de", "http://h.net?q=/a", "http://h.net#f", "://", "http://www.bad.net/p.html",
            "http://bad.net/p/", "http://bad.net/q", "http://h.net/\n/x?y"]
    frame = spark.createDataFrame([(i, u, "x", "x") for i, u in enumerate(urls)] + [(14, urls[14], "x", "x")],
                                  "page_id bigint, url string, block string, host string")
    listed = spark.createDataFrame([("http://m.bad.net/p",), (None,), ("nothing",), ("http://bad.net/p",)], "url string")
    rows = url_filters.judge(frame, RULES, listed).collect()
    assert len(rows) == len(urls) + 1
    for r in rows:
        host, path = brute_url(urls[r["page_id"]])
        rule, verdict = brute_rule(host, path)
        bad = r["page_id"] in (13, 14)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if bad else "allow"))
    assert url_filters.judge(frame.limit(0), RULES, listed).count() == 0
    assert url_filters.judge(frame, RULES, listed.limit(0)).where("listed").count() == 0


def test_filter_never_misses_and_mostly_rejects(spark):
    listed = keep(spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k")), "test-list")
    rows = spark.range(9000).select(F.concat(F.lit("k"), "id").alias("k"), "id")
    maybe, sure = bloom.listed_or_not(rows, "k", listed)
    assert maybe.where("id < 3000").count() == 3000 and maybe.count() + sure.count() == 9000
    assert maybe.count() < 3300
    tight, blocks = bloom.build_filter(listed, "k", 3000, most_blocks=2)
    assert blocks == 2 and bloom.possible(rows, "k", tight, blocks).where("_maybe and id < 3000").count() == 3000
