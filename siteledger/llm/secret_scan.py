"""Secret scans: fixed patterns, and character Markov models of random strings against ordinary identifiers.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import keep

# Kinds in the order that breaks ties, their patterns and the group and length that make them count.
# ``{24,}`` and ``{16,}`` find the same runs as ``+`` does with shorter runs dropped afterwards.
ASSIGN = (r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
          r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
BASE = (("assign", ASSIGN, 2, 6), ("access", r"AKIA[A-Z0-9]{16,}", 0, 20), ("hex", r"[0-9a-f]{24,}", 0, 24))
RANDOM = "random"
# Runs that the models judge, and the shortest run and the shortest known secret they are asked about or learn from.
RUN, LEAST = r"[A-Za-z0-9+/_=-]{16,}", 16
# Symbols of the models: the characters from ``+`` to ``z``.
FIRST_SYMBOL, SYMBOLS = 43, 80
# Summed log-likelihood ratio in thousandths of a nat beyond which a run counts as random: odds of 1,000 to 1.
MARGIN = 6908

SPAN = "struct<start: int, rank: int, end: int, value: string>"


def _found(text: Column, pattern: str, group: int, matches: str, pieces: str, values: str) -> dict[str, Column]:
    found = F.size(matches) > 0
    none = F.array().cast("array<string>")
    return {pieces: F.when(found, F.split(text, pattern, -1)).otherwise(none),
            values: F.when(found, F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).otherwise(none)
            if group else F.col(matches)}


def _spans(matches: str, pieces: str, values: str, rank: int) -> Column:
    """Spans in code points of the matches, from the lengths of the text's pieces between them."""
    steps = F.arrays_zip(F.transform(matches, F.length).alias("size"),
                         F.transform(F.slice(pieces, 1, F.size(matches)), F.length).alias("gap"),
                         F.col(values).alias("value"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), (begin + x["size"]).alias("end"),
                        x["value"].alias("value"))
        return F.struct((begin + x["size"]).alias("at"), F.array_append(acc["spans"], span).alias("spans"))

    return F.aggregate(steps, start, step, lambda acc: acc["spans"])


def _long_enough(spans: Column, least: int) -> Column:
    return F.filter(spans, lambda s: F.length(s["value"]) >= least)


def _count(spans: Column, rank: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("bigint")


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, base, runs): spans of the fixed patterns, and runs of LEAST or more symbols beside them.

    Each pattern's matches are leftmost and do not overlap; spans of different patterns may.  One pass over the texts, in
    place: nothing is shuffled.  Runs that touch a base span are left out.
    """
    frame = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kinds = [*BASE, (RANDOM, RUN, 0, LEAST)]
    frame = frame.withColumns({f"m{k}": F.regexp_extract_all("text", F.lit(p), F.lit(0)) for k, (_, p, _, _) in enumerate(kinds)})
    cut = {}
    for k, (_, pattern, group, _) in enumerate(kinds):
        cut |= _found(F.col("text"), pattern, group, f"m{k}", f"p{k}", f"v{k}")
    frame = frame.withColumns(cut)
    spans = [_long_enough(_spans(f"m{k}", f"p{k}", f"v{k}", k), least) for k, (_, _, _, least) in enumerate(kinds)]
    frame = frame.select("doc_id", F.concat(*spans[:-1]).alias("base"), spans[-1].alias("runs"))
    alone = F.filter("runs", lambda r: ~F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    return frame.select("doc_id", "base", F.when(F.size("base") == 0, F.col("runs")).otherwise(alone).alias("runs"))


def samples(found: DataFrame) -> DataFrame:
    """(value, random): distinct known secrets of LEAST or more symbols, labelled true, and all other runs, false."""
    known = found.select(F.explode("base.value").alias("value")).where(F.length("value") >= LEAST)
    other = found.select(F.explode("runs.value").alias("value"))
    return known.withColumn("random", F.lit(True)).unionAll(other.withColumn("random", F.lit(False))).distinct()


def _pairs(value: Column) -> Column:
    """Index of each pair of neighbouring symbols of a run."""
    symbols = F.transform(F.split(value, ""), lambda c: F.ascii(c) - FIRST_SYMBOL)
    return F.zip_with(F.slice(symbols, F.lit(1), F.size(symbols) - 1), F.slice(symbols, F.lit(2), F.size(symbols) - 1),
                      lambda a, b: a * SYMBOLS + b)


def fit(labelled: DataFrame) -> list[int] | None:
    """Log-likelihood ratio of each pair of symbols, in thousandths of a nat: random strings against the others.

    ``labelled`` has ``value`` (symbols from ``+`` to ``z`` only) and ``random``.  Both models are first-order chains that fall
    back on how often a symbol follows at all, with the weight of SYMBOLS observations.  A run that is judged is itself among
    the identifiers, so each pair counts once less there: an unknown secret does not make its own pairs likely.  The table has SYMBOLS squared entries, whatever the input.
    None if a label is missing.  Runs a job.
    """
    pairs = labelled.where(F.length("value") > 1).select("random", F.explode(_pairs(F.col("value"))).alias("pair"))
    counts = {(r["random"], r["pair"]): r["n"] for r in
              pairs.groupBy("random", "pair").agg(F.count("*").alias("n")).collect()}
    if len({label for label, _ in counts}) < 2:
        return None
    spark, size = labelled.sparkSession, SYMBOLS * SYMBOLS
    table = spark.createDataFrame([(p, counts.get((True, p), 0), counts.get((False, p), 0)) for p in range(size)],
                                  "pair int, n1 bigint, n0 bigint")
    likely = []
    for n, less in (("n1", 0), ("n0", 1)):
        sums = [F.greatest(F.sum(n).over(Window.partitionBy(key)) - less, F.lit(0)) for key in (
            F.floor(F.col("pair") / SYMBOLS), F.col("pair") % SYMBOLS, F.lit(0))]
        share = (sums[1] + 1).cast("double") / (sums[2] + SYMBOLS)
        likely.append((F.greatest(F.col(n) - less, F.lit(0)) + SYMBOLS * share) / (sums[0] + SYMBOLS))
    found = table.select("pair", F.floor(1000 * F.log(likely[0] / likely[1])).cast("int").alias("ratio")).collect()
    return [r["ratio"] for r in sorted(found)]


def _ratio(value: Column, model: list[int]) -> Column:
    table = F.split(F.lit(",".join(map(str, model))), ",").cast("array<int>")
    return F.aggregate(_pairs(value), F.lit(0).cast("bigint"), lambda total, pair: total + F.get(table, pair))


def judge(found: DataFrame, model: list[int] | None, margin: int = MARGIN) -> DataFrame:
    """doc_id, counts of the base kinds, base spans, and all spans with the runs that the models call random.

    Spans are structs (start, rank, end, value) sorted by start, then kind; ``rank`` is the kind's place in ``KINDS``.
    """
    added = F.array().cast(f"array<{SPAN}>") if model is None else \
        F.filter("runs", lambda r: _ratio(r["value"], model) >= margin)
    counts = [_count(F.col("base"), k).alias(f"n_{name}") for k, (name, *_) in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sort_array("base").alias("base"),
                        F.sort_array(F.concat("base", added)).alias("spans"))


KINDS = tuple(name for name, *_ in BASE) + (RANDOM,)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", margin: int = MARGIN) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base and spans of every document.

    1. One pass finds the fixed patterns and the other long runs, and writes both; texts are read no more.
    2. Known secrets are samples of random strings, the other runs of ordinary identifiers (a few unknown secrets
       among them do not matter to counts over the whole corpus).  Equal samples count once, so copies weigh nothing.
    3. A run is added where the models' log-likelihood ratio reaches ``margin``.  Base spans all stay.

    Null text counts as empty and has no spans.  Repeated rows and null ids are judged each.  Without a known secret or another
    run there is no model, and only base spans are found.  A text of any length is scanned whole, in its
    own row.  No rows give no rows; other columns are not looked at.  Runs jobs.
    """
    found = keep(find(docs, doc_id, text), "found")
    return judge(found, fit(samples(found)), margin)
