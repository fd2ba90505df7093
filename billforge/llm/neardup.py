"""Near-duplicate records by meet-in-the-middle ball hashing of min-hash fingerprints, verified exactly.

A record's fingerprints are short words of min-hash symbols. Between fingerprints the distance counts erased and inserted
symbols, so two that differ in one symbol are at distance 2 (the radius). Every fingerprint emits all variants within half
the radius: itself with each one of its symbols erased. Two fingerprints within the radius meet at the variant with the
differing symbol erased, so a shuffle on variants brings together just the pairs within the ball; no pair of records is
compared that shares no variant. Colliding pairs are deduplicated, thinned by a 128-bit sketch and verified on their whole
sets of word sequences.

Exact copies are one class throughout: they are searched once and joined back at the end. The number and length of the
fingerprints follow from the threshold (Plan): at 0.7 they are 16 of 6 symbols, and a pair of likeness 0.7 is missed with
probability 1.7e-4, one of 0.75 with 1e-5, one of 0.8 with 3e-7. Scale: no text is shuffled. One reading
gives digests and sketches, a short row each, which is kept; another the variants, of which two longs each are shuffled and sorted, so copies and pairs are told along a run of
equal variants (a run is one task's work, its pairs made a block at a time). A third reading makes the sets of those records only
that have a candidate: a bitmap of them, 32 to 64 bits each, goes to the driver and to the workers, and the join drops what it lets through wrongly.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F, types as T

from billforge.llm.address import spans, whole
from billforge.session import checkpoint, spread

SKETCH, SEED, MISSED, DEVIATIONS = 128, 20240229, 2e-4, 5.7
_WORD_SIGNS = bytes(c if chr(c).isascii() and chr(c).isalnum() and not chr(c).isupper() else 32 for c in range(256))
_VALUES = np.random.default_rng(SEED + 1).integers(0, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


@dataclass(frozen=True)
class Plan:
    """How many fingerprints of how many symbols a threshold needs, and in how many bits the sketches of a pair may differ."""

    symbols: int
    fingerprints: int
    bits: int

    @classmethod
    def of(cls, threshold: float) -> Plan:
        """The longest fingerprints (at most six symbols) of which SKETCH min-hashes hold as many as miss a pair at the threshold with a probability of at most MISSED.

        Two fingerprints share a variant if at most one of their symbols differs. A bit of the sketches of a pair at the
        threshold differs with probability (1 - threshold) / 2; the bound is DEVIATIONS deviations above (about one pair in 10^8).
        """
        odds = (1 - threshold) / 2
        bits = math.floor(SKETCH * odds + DEVIATIONS * math.sqrt(SKETCH * odds * (1 - odds)))
        for symbols in (6, 5, 4, 3):
            meet = threshold**symbols + symbols * threshold ** (symbols - 1) * (1 - threshold)
            many = 1 if meet >= 1 else max(1, math.ceil(math.log(MISSED) / math.log1p(-meet)))
            if symbols * many <= SKETCH:
                return cls(symbols, many, bits)
        raise ValueError(f"a likeness of {threshold} is below what {SKETCH} min-hashes find")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def normal(text: str) -> bytes:
    """Lower case, every run of characters other than a-z and 0-9 as one blank."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_WORD_SIGNS).split())


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of normal texts, and their offsets by text: a polynomial over the signs of a word, modulo 2^64, taken from sums along all texts."""
    joined = b" ".join(t for t in texts if t) + b" "
    signs = np.frombuffer(joined, np.uint8)
    ends = np.flatnonzero(signs == 32)
    starts = np.append(0, ends[:-1] + 1)
    with np.errstate(over="ignore"):
        sums = np.append(np.uint64(0), np.cumsum(_VALUES[signs] * np.cumprod(np.full(len(signs), _BASE))))
        h = _mix((sums[ends] - sums[starts]) * np.cumprod(np.full(len(signs), _INVERSE))[starts])
    sizes = [t.count(b" ") + 1 if t else 0 for t in texts]
    return h[: sum(sizes)], np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all sequences of ``width`` words, and their offsets by record; a record with fewer words has none."""
    sizes = np.maximum(np.diff(offsets) - width + 1, 0)
    out = np.concatenate([[0], np.cumsum(sizes)])
    first = np.repeat(offsets[:-1] - out[:-1], sizes) + np.arange(out[-1])
    h = np.zeros(len(first), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + words[first + k])
    return h, out


def _constants() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 1 << 63, SKETCH, dtype=np.uint64), rng.integers(0, 1 << 63, SKETCH, dtype=np.uint64) | np.uint64(1)


def fingerprint(words: np.ndarray, offsets: np.ndarray, width: int, plan: Plan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(variants, sketches, whether there are any) of the records with at least ``width`` words."""
    h, at = shingle_hashes(words, offsets, width)
    some = np.flatnonzero(np.diff(at))
    starts = at[:-1][some]
    mins = np.empty((len(some), SKETCH), np.uint64)
    xor, mul = _constants()
    with np.errstate(over="ignore"):
        for j in range(SKETCH if len(some) else 0):
            x = (h ^ xor[j]) * mul[j]
            mins[:, j] = np.minimum.reduceat(x ^ (x >> np.uint64(32)), starts)
        bits = np.packbits((_mix(mins) & np.uint64(1)).astype(np.uint8), axis=1).view(np.int64).reshape(-1, SKETCH // 64)
        used = plan.symbols * plan.fingerprints
        part = (mins[:, :used] * mul[None, :used]).reshape(-1, plan.fingerprints, plan.symbols)
        salt = xor[:used].reshape(1, plan.fingerprints, plan.symbols)
        variants = _mix(part.sum(axis=2, keepdims=True) - part + salt)  # the fingerprint with its i-th symbol erased
    return variants.reshape(len(some), -1).view(np.int64), bits, some


def _keys(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(d[:8] for d in digests), np.int64)


def _prints(width: int, plan: Plan, variants: bool):
    """(key, variants) of each record, or its (id, made, d, key, s1, s2, some)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                b = batch.slice(at, 512)
                texts = [normal(t) for t in b["text"].to_pylist()]
                digests = [hashlib.md5(t).digest() for t in texts]
                keys = _keys(digests)
                found, bits, some = fingerprint(*word_hashes(texts), width, plan)
                if variants:
                    lists = pa.ListArray.from_arrays(np.arange(0, found.size + 1, plan.symbols * plan.fingerprints, dtype=np.int32), pa.array(found.ravel()))
                    yield pa.RecordBatch.from_arrays([pa.array(keys[some]), lists], ["key", "variants"])
                    continue
                sketch = np.zeros((len(texts), 2), np.int64)
                sketch[some] = bits
                yield pa.RecordBatch.from_arrays([b["id"], b["made"], pa.array(digests, pa.binary()), pa.array(keys), pa.array(sketch[:, 0].copy()), pa.array(sketch[:, 1].copy()), pa.array(np.isin(np.arange(len(texts)), some))], ["id", "made", "d", "key", "s1", "s2", "some"])

    return run


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key_1, key_2), key_1 < key_2, of what shares a variant; the rows (variant, key) are sorted."""
    for b in whole(batches, "variant"):
        variant, key = b["variant"].to_numpy(), b["key"].to_numpy()
        once = np.flatnonzero(np.append(True, (variant[1:] != variant[:-1]) | (key[1:] != key[:-1])))  # copies count once
        variant, key = variant[once], key[once]
        for entry, k in spans(np.searchsorted(variant, variant, "right") - np.arange(len(variant)) - 1):
            yield pa.RecordBatch.from_arrays([pa.array(key[entry]), pa.array(key[entry + 1 + k])], ["key_1", "key_2"])


def _sets(width: int, wanted: Broadcast):
    """(rep, key, shingles) of the records whose bit is set: the wanted ones and a few others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                b = batch.slice(at, 512)
                texts = [normal(t) for t in b["text"].to_pylist()]
                keys, ids = _keys([hashlib.md5(t).digest() for t in texts]), b["id"].to_numpy()
                place = (keys ^ ids) & (8 * len(bits) - 1)
                hits = np.flatnonzero(bits[place >> 3] >> (place & 7).astype(np.uint8) & 1)
                h, cut = shingle_hashes(*word_hashes([texts[k] for k in hits]), width)
                sets = [np.unique(h[a:b]).view(np.int64) for a, b in zip(cut[:-1], cut[1:])]
                lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32), pa.array(np.concatenate([*sets, np.empty(0, np.int64)])))
                yield pa.RecordBatch.from_arrays([pa.array(ids[hits]), pa.array(keys[hits]), lists], ["rep", "key", "shingles"])

    return run


def _bitmap(needed: DataFrame) -> np.ndarray:
    """A bit for each (rep, key), at key xor rep: 32 to 64 bits a row, put together by the executors."""
    size = max(1 << 15, 1 << (32 * needed.count()).bit_length())
    at = needed.select((F.col("key").bitwiseXOR(F.col("rep")).bitwiseAND(F.lit(size - 1)) + 1).alias("at"))
    parts = at.groupBy(F.bitmap_bucket_number("at").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect()
    out = np.zeros((size >> 15, 4096), np.uint8)
    for k, bits in parts:
        out[k - 1] = np.frombuffer(bits, np.uint8)
    return out.ravel()


def _scan(records: DataFrame, key: Column, made: Column, text: Column) -> DataFrame:
    return spread(records.select(key.cast("bigint").alias("id"), made.alias("made"), text.alias("text")).where("id is not null and text is not null"))


def classes(scan: DataFrame, width: int, plan: Plan) -> tuple[DataFrame, DataFrame]:
    """(members: id, rep, some; reps: rep, d, key, s1, s2, some): records with equal words are one class, named by its least id.

    Of several rows of an id the one with the greatest ``made`` counts (null the least, ties to the greatest digest). Rows
    with a null id or text are left out.
    """
    kind = T.StructType(scan.select("id", "made").schema.fields + T._parse_datatype_string("d binary, key bigint, s1 bigint, s2 bigint, some boolean").fields)
    prints = scan.mapInArrow(_prints(width, plan, False), kind).persist()  # a short row per record
    current = prints.groupBy("id").agg(F.max(F.struct("made", "d", "key", "s1", "s2", "some")).alias("m")).select("id", "m.*")
    reps = current.groupBy("d").agg(F.min("id").alias("rep"), *(F.first(c).alias(c) for c in ("key", "s1", "s2", "some")))
    return current.select("id", "d", "some").join(reps.select("d", "rep"), "d").select("id", "rep", "some").persist(), reps


def similar_classes(scan: DataFrame, reps: DataFrame, width: int, threshold: float, plan: Plan) -> DataFrame:
    """(rep_1, rep_2, common, total) of classes whose sets of word sequences have common / total >= threshold, rep_1 < rep_2."""
    emitted = scan.mapInArrow(_prints(width, plan, True), "key bigint, variants array<bigint>").select(F.explode("variants").alias("variant"), "key").repartition("variant").sortWithinPartitions("variant", "key")
    met = emitted.mapInArrow(_met, "key_1 bigint, key_2 bigint").distinct()
    sketch = reps.where("some").select("key", "rep", "s1", "s2")
    near = met.join(sketch.toDF("key_1", "rep_1", "a1", "a2"), "key_1").join(sketch.toDF("key_2", "rep_2", "b1", "b2"), "key_2")
    near = near.where(F.expr(f"bit_count(a1 ^ b1) + bit_count(a2 ^ b2) <= {plan.bits}")).select("rep_1", "key_1", "rep_2", "key_2")
    near = checkpoint(near)  # pairs of ids; read several times below
    needed = near.select("rep_1", "key_1").union(near.select("rep_2", "key_2")).toDF("rep", "key").distinct()
    wanted = scan.sparkSession.sparkContext.broadcast(_bitmap(needed))
    sets = scan.mapInArrow(_sets(width, wanted), "rep bigint, key bigint, shingles array<bigint>").repartition("rep", "key").dropDuplicates(["rep", "key"])  # one exchange for both sides
    both = near.join(sets.toDF("rep_1", "key_1", "x"), ["rep_1", "key_1"]).join(sets.toDF("rep_2", "key_2", "y"), ["rep_2", "key_2"])
    counted = both.select(F.least("rep_1", "rep_2").alias("rep_1"), F.greatest("rep_1", "rep_2").alias("rep_2"), F.size(F.array_intersect("x", "y")).alias("common"), (F.size("x") + F.size("y")).alias("both")).withColumn("total", F.col("both") - F.col("common"))
    return counted.where(F.col("common") >= F.ceil(F.col("total") * threshold - 1e-9)).select("rep_1", "rep_2", "common", "total")


def similar_pairs(records: DataFrame, key: Column, made: Column, text: Column, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """(id_1, id_2), smaller first, of all records whose likeness is at least the threshold.

    The likeness is the number of different sequences of ``width`` words that both have, divided by the number that at
    least one has; records with fewer words have none and form no pair. Rows with null id or text are left out, an empty
    table gives no pair, further columns are not looked at. Copies are paired too (the result is then as large as asked).
    """
    scan, plan = _scan(records, key, made, text), Plan.of(threshold)
    members, reps = classes(scan, width, plan)
    pairs = similar_classes(scan, reps, width, threshold, plan)
    across = pairs.join(members.select(F.col("id").alias("x"), F.col("rep").alias("rep_1")), "rep_1").join(members.select(F.col("id").alias("y"), F.col("rep").alias("rep_2")), "rep_2").select("x", "y")
    copies = members.where("some").select("id", "rep")
    same = copies.alias("a").join(copies.alias("b"), F.expr("a.rep = b.rep and a.id < b.id")).select(F.col("a.id").alias("x"), F.col("b.id").alias("y"))
    return across.unionByName(same).select(F.least("x", "y").alias("id_1"), F.greatest("x", "y").alias("id_2"))


def similar_groups(records: DataFrame, key: Column, made: Column, text: Column, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row per record: (id, class_id, group_id, n_links). Its class of exact copies, the connected group of classes it
    is in (the least id), and to how many other classes it is linked directly. Records without words are their own class.
    """
    scan, plan = _scan(records, key, made, text), Plan.of(threshold)
    members, reps = classes(scan, width, plan)
    links = checkpoint(similar_classes(scan, reps, width, threshold, plan).select("rep_1", "rep_2"))
    ends = links.select(F.explode(F.array("rep_1", "rep_2")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("n_links"))
    groups = connected(links)
    out = members.join(ends, "rep", "left").join(groups, "rep", "left")
    return out.select("id", F.col("rep").alias("class_id"), F.coalesce("group_id", "rep").alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def connected(links: DataFrame) -> DataFrame:
    """(rep, group_id): the least id that links (rep_1, rep_2) lead to.

    Alternates large-star and small-star steps, each a shuffle of the links, until the links no longer change; the number
    of rounds grows with the logarithm of the longest path. Only counts reach the driver.
    """
    edges = links.select(F.greatest("rep_1", "rep_2").alias("u"), F.least("rep_1", "rep_2").alias("v")).where("u <> v").distinct()
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        edges = checkpoint(small)
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("rep"), F.col("v").alias("group_id")).unionByName(edges.select(F.col("v").alias("rep"), F.col("v").alias("group_id")).distinct())
