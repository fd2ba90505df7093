"""Mixing sources to target weights, by fitting each source's token budget as a subset sum.

The total is the greatest at which no source needs its documents more than ``max_repeats`` times, unless a total is given. A
source's budget is its share of the total: as many whole passes over its documents as fit, and for the rest a subset of
documents. That subset is fitted on counts of documents by exact token length: most of it by taking the same fraction of
every length, what then remains by a bounded-knapsack dynamic program over the lengths still to be had, which hits the
budget exactly or misses it by the least possible. Which documents of a length are taken is decided by a seeded hash.

Scale: token counts are a map; per source and length only counts reach the driver (the number of different lengths, not of
documents). Documents are selected without sorting a length's documents in one task: counts by (source, length, hash
bucket) give the bucket in which the last selected document falls, and only that bucket is ranked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from billforge.session import broadcast_if_small, checkpoint, spread

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
SEED, BUCKETS = 17, 1024
#: The dynamic program fits at most this much of a budget, in units of its source's longest document, or this many tokens.
KNAPSACK_DOCUMENTS, KNAPSACK_TOKENS = 4, 200_000


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                texts = [t or "" for t in b["text"].to_pylist()]
                n = [len(x.ids) for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
                yield pa.RecordBatch.from_arrays([b["doc_id"], b["source"], pa.array(n, pa.int64())], ["doc_id", "source", "n_tokens"])

    return run


def token_counts(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, n_tokens) of documents (doc_id, source, text); a null text has none."""
    return spread(documents.select("doc_id", "source", "text")).mapInArrow(_count(tokenizer), "doc_id bigint, source string, n_tokens bigint")


def knapsack(counts: dict[int, int], budget: int) -> dict[int, int]:
    """How many of each length to take so that their sum is as near to the budget as possible; of two as near, the lower.

    Bounded by the counts: each is split into powers of two, and for each reachable sum the first item that reached it is kept.
    """
    items = []
    for length in sorted((x for x in counts if x > 0), reverse=True):
        left, k = min(counts[length], (budget + length) // length), 1
        while left > 0:
            items.append((length, min(k, left)))
            left, k = left - k, 2 * k
    top = budget + max((x for x in counts if x > 0), default=0)
    reached = np.zeros(top + 1, bool)
    first = np.full(top + 1, -1, np.int32)
    reached[0] = True
    for i, (length, k) in enumerate(items):
        step = length * k
        if step > top:
            continue
        new = np.zeros_like(reached)
        new[step:] = reached[: top + 1 - step]
        new &= ~reached
        first[new] = i
        reached |= new
        if reached[budget]:
            break
    sums = np.flatnonzero(reached)
    at = int(min(sums, key=lambda s: (abs(int(s) - budget), s)))
    out: dict[int, int] = {}
    while at > 0:
        length, k = items[first[at]]
        out[length] = out.get(length, 0) + k
        at -= length * k
    return out


def fit(counts: dict[int, int], budget: int) -> dict[int, int]:
    """How many documents of each length to take for the budget (at most all of them)."""
    size = sum(n * c for n, c in counts.items())
    if budget >= size:
        return dict(counts)
    longest = max(counts)
    rest = min(budget, max(KNAPSACK_DOCUMENTS * longest, KNAPSACK_TOKENS))
    fraction = (budget - rest) / size
    taken = {n: int(c * fraction) for n, c in counts.items()}
    left = budget - sum(n * k for n, k in taken.items())
    for n in sorted(counts, reverse=True):  # rounding down leaves up to a document of each length: take those, longest first
        if left <= rest:
            break
        if taken[n] < counts[n] and left - n >= 0:
            taken[n] += 1
            left -= n
    more = knapsack({n: counts[n] - taken[n] for n in counts}, left)
    return {n: k for n in counts if (k := taken[n] + more.get(n, 0))}


def plan(lengths: dict[str, dict[int, int]], targets: dict[str, tuple[float, int]], total: int | None = None) -> tuple[dict[str, tuple[int, int, dict[int, int]]], int]:
    """({source: (budget, whole passes, {length: documents of one more pass})}, total).

    Shares are taken relative to those of the sources that have tokens.
    """
    size = {s: sum(n * c for n, c in lengths.get(s, {}).items()) for s in targets}
    usable = {s: w for s, (w, r) in targets.items() if size[s] and w > 0 and r > 0}
    norm = sum(usable.values())
    if not usable:
        return {}, 0
    most = min(int(targets[s][1] * size[s] / (w / norm)) for s, w in usable.items())
    total = most if total is None else min(total, most)
    out = {}
    for s, w in usable.items():
        budget = min(round(total * w / norm), targets[s][1] * size[s])
        passes = budget // size[s]
        more = fit(lengths[s], budget - passes * size[s]) if passes < targets[s][1] and budget > passes * size[s] else {}
        out[s] = (budget, passes, more)
    return out, total


def mix(documents: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER, total: int | None = None, seed: int = SEED) -> DataFrame:
    """(doc_id, source, n_tokens, times): how often every document is used, 0 included.

    ``documents`` has doc_id (unique), source and text, ``targets`` source, target_share and max_repeats. Documents of a
    source without target, and those without tokens, are used 0 times; targets with null or zero share or repeats count as
    none; a null source is no source; an empty table on either side gives times 0 or no rows. Further columns are ignored.
    """
    wanted = {r[0]: (float(r[1] or 0), int(r[2] or 0)) for r in targets.select("source", "target_share", "max_repeats").where("source is not null").collect()}  # a row per source
    counted = checkpoint(token_counts(documents, tokenizer).withColumn("h", F.xxhash64(F.lit(seed), "doc_id")))
    lengths: dict[str, dict[int, int]] = {}
    for s, n, c in counted.where("n_tokens > 0").groupBy("source", "n_tokens").count().collect():  # different lengths, not documents
        lengths.setdefault(s, {})[n] = c
    plans, _ = plan(lengths, wanted, total)
    rows = [(s, n, passes, more.get(n, 0)) for s, (_, passes, more) in plans.items() for n in lengths[s]]
    wants = counted.sparkSession.createDataFrame(rows, "source string, n_tokens bigint, passes int, more bigint")
    wants = broadcast_if_small(wants)
    tagged = counted.join(wants, ["source", "n_tokens"], "left").withColumn("bucket", F.pmod("h", F.lit(BUCKETS)).cast("int"))
    some = tagged.where("more > 0").groupBy("source", "n_tokens", "bucket").agg(F.count(F.lit(1)).alias("c"), F.first("more").alias("m"))
    run = F.sum("c").over(W.partitionBy("source", "n_tokens").orderBy("bucket"))
    edge = some.withColumn("upto", run).where("upto >= m and upto - c < m").select("source", "n_tokens", F.col("bucket").alias("edge"), (F.col("m") - F.col("upto") + F.col("c")).alias("of_edge"))
    placed = tagged.join(broadcast_if_small(edge), ["source", "n_tokens"], "left")
    ranked = placed.where("bucket = edge").withColumn("rank", F.row_number().over(W.partitionBy("source", "n_tokens", "bucket").orderBy("h", "doc_id")))
    extra = F.when(F.col("bucket") < F.col("edge"), 1).when((F.col("bucket") == F.col("edge")) & (F.col("rank") <= F.col("of_edge")), 1).otherwise(0)
    every = placed.where("edge is null or bucket <> edge").withColumn("rank", F.lit(None).cast("int")).unionByName(ranked)
    return every.select("doc_id", "source", "n_tokens", (F.coalesce("passes", F.lit(0)) + extra).cast("int").alias("times"))


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: its documents and tokens, the documents and tokens used, the most repeats, its target and its actual share."""
    sums = mixed.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_documents"), F.sum("n_tokens").alias("n_tokens"), F.sum((F.col("times") > 0).cast("int")).alias("n_used"),
        F.sum(F.col("n_tokens") * F.col("times")).alias("used_tokens"), F.max("times").alias("most_repeats"))
    total = F.sum("used_tokens").over(W.partitionBy())  # a row per source
    return sums.join(targets.select("source", "target_share"), "source", "left").withColumn("actual_share", F.coalesce(F.col("used_tokens") / F.nullif(total, F.lit(0)), F.lit(0.0)))
