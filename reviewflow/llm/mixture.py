"""Mixing sources to target weights -> copies of each document, and the actual shares.

Method: Pareto order sampling. Each document has an expected number of copies. Its whole part is allocated for certain; the
rest is the inclusion probability of one more copy. Documents are ranked by random odds u/(1-u) divided by inclusion odds
p/(1-p), and the first ones are taken until the source's remaining size is filled: a sample of fixed size (in tokens) with
unequal probabilities. The random numbers are hashes of document, mixture and seed, so a lost task repeats its choice.

Budget: ``total_tokens``, or the size of all the mixture's documents. A source can give at most max_repeats copies of its
documents; what it can't give is spread over the others in proportion to their targets, and the report shows it.
Expected copies fall with the number of documents of the source that have the same text: a text that occurs k times has
k documents with 1/k of the weight each.

Scale: nothing is ranked within a whole source. Odds are counted in fine bins; the bin where a source's size is reached is found
from the counts, and only that bin's documents are ordered.

Defined results
* null and empty texts have no tokens and are never chosen; a document without source belongs to no target.
* a source without documents gives nothing and is reported with actual share 0; so is one whose target is null or not positive.
* ties in odds go by doc_id; an empty table gives an empty mixture and shares of 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from reviewflow.llm.tokens import DEFAULT_VOCABULARY, encoder
from reviewflow.storage import ship_package, written

#: Bins of the logarithm of the odds: this many for one unit, over -EDGE..EDGE.
FINE, EDGE = 500, 40


def _size_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for b in batches:
            texts = b.column(2).to_pylist()
            n = [len(e.ids(t)) for t in texts]
            h = [xxhash.xxh3_64_intdigest((t or "").encode("utf-8", "surrogatepass")) - (1 << 63) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(h, pa.int64())], names=["doc_id", "source", "n", "h"])

    return run


def _levels(g: pd.DataFrame) -> pd.DataFrame:
    """One mixture: each source's budget, and the factor that makes its expected copies add up to it."""
    g = g.sort_values(["source", "k"])
    first = g.drop_duplicates("source")
    total = float(first["budget"].iloc[0]) if first["budget"].notna().any() else float(g["tokens"].sum())
    target = dict(zip(first["source"], first["target_share"].clip(lower=0).fillna(0.0), strict=True))
    repeats = dict(zip(first["source"], first["max_repeats"].fillna(0).clip(lower=0).astype(float), strict=True))
    cap = {s: repeats[s] * float(g.loc[g["source"] == s, "tokens"].sum()) for s in target}
    give, open_sources, left = {s: 0.0 for s in target}, {s for s in target if target[s] > 0 and cap[s] > 0}, min(total, sum(cap[s] for s in target if target[s] > 0))
    while open_sources and left > 1e-9:
        weight = sum(target[s] for s in open_sources)
        full = {s for s in open_sources if cap[s] <= left * target[s] / weight + 1e-9}
        for s in full or open_sources:
            give[s] = cap[s] if full else left * target[s] / weight
        left -= sum(give[s] for s in full or open_sources)
        open_sources = open_sources - full if full else set()
    out = []
    for s in target:
        rows = g[g["source"] == s]
        k, tokens, r = rows["k"].to_numpy(float), rows["tokens"].to_numpy(float), repeats[s]
        lo, hi = 0.0, r * float(k.max()) if len(k) and k.max() > 0 else 0.0
        for _ in range(80):  # the factor t of min(r, t / k), by halving
            mid = (lo + hi) / 2
            expected = sum(min(r, mid / a) * b for a, b in zip(k, tokens, strict=True) if a > 0)
            lo, hi = (mid, hi) if expected < give[s] else (lo, mid)
        out.append((g["mixture"].iloc[0], s, target[s], r, give[s], hi))
    cols = list(zip(*out, strict=True))
    kinds = [object, object, float, float, float, float]
    return pd.DataFrame({n: pd.Series(list(c), dtype=t) for n, c, t in zip(["mixture", "source", "target_share", "max_repeats", "give", "factor"], cols, kinds, strict=True)})


def _plan(documents: DataFrame, targets: DataFrame, total_tokens: int | None, path: str) -> tuple[DataFrame, DataFrame]:
    """(units, plan): the documents with size and number of equal texts in their source; budget and factor of each (mixture, source)."""
    ship_package(documents.sparkSession)
    t = targets.groupBy("mixture", "source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    named = documents.where("source IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text")
    sized = written(named.mapInArrow(_size_batches(path), "doc_id long, source string, n long, h long").where("n > 0"), "mix-sizes")
    # Partial counts come before the shuffle, so a text that fills a third of a source is no burden here.
    same = sized.groupBy("source", "h").agg(F.count("*").alias("k"))
    often = same.where("k > 1")
    units = written(sized.join(often, ["source", "h"], "left").select("doc_id", "source", "n", F.coalesce("k", F.lit(1)).alias("k")), "mix-units")
    sizes = units.groupBy("source", "k").agg(F.sum("n").alias("tokens"))
    histogram = t.join(sizes, "source", "left").select(
        "mixture", "source", "target_share", "max_repeats", F.coalesce("k", F.lit(0)).alias("k"), F.coalesce("tokens", F.lit(0)).alias("tokens"), F.lit(total_tokens).cast("double").alias("budget")
    )
    schema = "mixture string, source string, target_share double, max_repeats double, give double, factor double"
    return units, written(histogram.groupBy("mixture").applyInPandas(_levels, schema), "mix-plan")


def _chosen(units: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """(mixture, doc_id, source, n, copies)."""
    each = units.join(plan, "source").withColumn("expected", F.least("max_repeats", F.col("factor") / F.col("k")))
    # Copies within a rounding error of a whole number are whole.
    whole = F.floor(F.col("expected") + 1e-9)
    p = F.greatest(F.col("expected") - whole, F.lit(0.0))
    u = (F.xxhash64("doc_id", "mixture", F.lit(seed)).bitwiseAND((1 << 52) - 1) + 0.5) / float(1 << 52)
    each = each.withColumn("whole", whole).withColumn("p", F.when(p > 1e-7, p).otherwise(0.0))
    odds = F.when(F.col("p") > 0, F.log(u / (1 - u)) - F.log(F.col("p") / (1 - F.col("p"))))
    each = written(each.select("mixture", "source", "doc_id", "n", "whole", "give", odds.alias("odds")), "mix-odds")
    place = F.floor((F.greatest(F.least(F.col("odds"), F.lit(float(EDGE))), F.lit(float(-EDGE))) + EDGE) * FINE)
    drawn = each.where("odds IS NOT NULL").withColumn("bin", place)
    key = ["mixture", "source"]
    certain = each.groupBy(*key).agg(F.sum(F.col("whole") * F.col("n")).alias("certain"), F.max("give").alias("give"))
    rest = certain.select(*key, (F.col("give") - F.col("certain")).alias("rest"))
    bins = drawn.groupBy(*key, "bin").agg(F.sum("n").alias("tokens"))
    upto = F.sum("tokens").over(W.partitionBy(*key).orderBy("bin"))
    cut = bins.withColumn("upto", upto).join(rest, key).withColumn("before", F.col("upto") - F.col("tokens"))
    cut = cut.select(*key, "bin", "before", "rest", F.when(F.col("upto") <= F.col("rest"), "all").when(F.col("before") < F.col("rest"), "part").alias("take"))
    met = drawn.join(cut.where("take IS NOT NULL"), [*key, "bin"])
    order = W.partitionBy(*key).orderBy("odds", "doc_id")
    part = met.where("take = 'part'").withColumn("reached", F.col("before") + F.sum("n").over(order.rowsBetween(W.unboundedPreceding, 0)))
    # The document in which the size is reached is taken if that comes nearer to it.
    part = part.where(F.col("reached") - F.col("n") / 2 <= F.col("rest"))
    more = met.where("take = 'all'").select("mixture", "doc_id").unionByName(part.select("mixture", "doc_id")).withColumn("more", F.lit(1))
    out = each.join(more, ["mixture", "doc_id"], "left").withColumn("copies", (F.col("whole") + F.coalesce("more", F.lit(0))).cast("int"))
    return out.where("copies > 0").select("mixture", "doc_id", "source", "n", "copies")


def _shares(chosen: DataFrame, plan: DataFrame) -> DataFrame:
    size = chosen.groupBy("mixture", "source").agg(F.sum(F.col("n") * F.col("copies")).alias("tokens"), F.count("*").alias("documents"), F.max("copies").alias("most_copies"))
    all_tokens = F.sum("tokens").over(W.partitionBy("mixture"))
    both = plan.join(size, ["mixture", "source"], "left").fillna(0, ["tokens", "documents", "most_copies"])
    share = F.when(all_tokens > 0, F.col("tokens") / all_tokens).otherwise(0.0)
    return both.select("mixture", "source", "target_share", share.alias("actual_share"), "tokens", "documents", "most_copies", F.col("max_repeats").cast("int").alias("max_repeats"))


def _mix(documents: DataFrame, targets: DataFrame, total_tokens: int | None, seed: int, path: str) -> tuple[DataFrame, DataFrame]:
    units, plan = _plan(documents, targets, total_tokens, path)
    chosen = written(_chosen(units, plan, seed), "mix-chosen")
    return chosen, written(_shares(chosen, plan), "mix-shares")


def mixed_documents(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 1, path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(mixture, doc_id, source, n_tokens, copies, target_share, actual_share) of every document that the mixture uses."""
    chosen, shares = _mix(documents, targets, total_tokens, seed, path)
    out = chosen.join(shares.select("mixture", "source", "target_share", "actual_share"), ["mixture", "source"])
    return out.select("mixture", "doc_id", "source", F.col("n").alias("n_tokens"), "copies", "target_share", "actual_share")


def share_report(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 1, path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(mixture, source, target_share, actual_share, tokens, documents, most_copies, max_repeats) of every target."""
    return _mix(documents, targets, total_tokens, seed, path)[1]
