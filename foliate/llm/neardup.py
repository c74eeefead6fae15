"""Near-duplicate records: min-max hashing of shingle sets, banded, with an exact check of the candidates.

Words are the runs of letters and digits of the lower-case text; a record is the set of its runs of k words.

* *Signatures.* Each of P random permutations is evaluated once per element; both its minimum and its maximum over the
  set are kept. Either agrees between two sets with probability equal to their Jaccard similarity, so P evaluations
  give 2 P unbiased values, of lower variance than those of independent permutations. All is done on whole batches of
  texts as arrays: characters to words to shingles to signatures, without a Python object per word.
* *Bands.* Two permutations' four values make a band. Records that agree on a band are candidates. At similarity s a
  pair is missed with probability (1 - s^4)^bands: below 0.002 at 0.6 with 48 bands. Sets of a few elements (file
  paths) take the minimum and the maximum without replacement, which lowers s^4 a little; they get more bands.
* *Exact copies first.* Records with equal sets form a class under one 64-bit key, and only classes are banded, joined
  and checked; so a class that holds a third of all rows is one row in every bucket. A task hands on the bands of a class
  once, however many of its rows it sees. Membership is joined back at the end.
* *Large buckets.* A bucket of more than BLOCK classes is cut into blocks, and each pair of blocks is a unit of its own,
  so no task holds all pairs of a bucket.
* *Check.* Every candidate is compared exactly, whatever the sizes: the whole sets are made again from the texts of one
  record a class, and of no others (a screen of fixed size keeps the rest back). A pair is compared in the unit of its
  most populous bucket, so a set travels once per unit and not once per pair.

The signature table is written once to the shared folder; buckets, checks and membership are read from it, each with
the columns it needs. There is no cap on buckets or partners.

Defined results: null ids or texts, and texts with fewer than k words, are in no pair; repeated rows count once; an id
with several texts takes part with each; texts of any length count whole; ties don't arise, a pair of ids comes once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliate.llm.lines import slices
from foliate.llm.screen import passes, screen
from foliate.session import written

BODY_BANDS, PATH_BANDS = 48, 80
BLOCK = 64  # classes of a bucket that are compared in one unit
SEEN = 1 << 18  # class keys a task remembers
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)  # multipliers of a public 64-bit mixer


@lru_cache(1)
def _alnum() -> np.ndarray:
    return np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)


@lru_cache(4)
def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(0, 1 << 32, (n, 1), np.uint32), rng.integers(0, 1 << 31, (n, 1), np.uint32) * np.uint32(2) + np.uint32(1)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * _M1
    h = h ^ (h >> np.uint64(33))
    h = h * _M2
    return h ^ (h >> np.uint64(33))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of every text, and the text each belongs to."""
    lower = [t.lower() for t in texts]
    ends = np.cumsum([len(t) + 1 for t in lower])
    points = np.frombuffer("\n".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = _alnum()[points]
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lengths = stops - starts
    first = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    powers = np.cumprod(np.full(int(lengths.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
    values = (points[inside].astype(np.uint64) + np.uint64(1)) * powers[within]
    return mix(np.add.reduceat(values, first)), np.searchsorted(ends, starts, "right")


def shingle_sets(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit elements of every text's set, in order of text and element, and their number per text."""
    h, text = word_hashes(texts)
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
    s = h[:n]
    for i in range(1, k):
        s = mix(s * np.uint64(3) + h[i : n + i])
    whole = text[:n] == text[k - 1 :]
    key = np.unique((text[:n][whole].astype(np.uint64) << np.uint64(32)) | (s[whole] >> np.uint64(32)))
    return key.astype(np.uint32), np.bincount((key >> np.uint64(32)).astype(np.int64), minlength=len(texts))


def signatures(elements: np.ndarray, counts: np.ndarray, bands: int) -> np.ndarray:
    """The band keys of every non-empty set: per band a hash of the minima and maxima of two permutations."""
    flip, factor = _permutations(2 * bands)
    begins = np.cumsum(counts) - counts
    low = np.empty((2 * bands, len(counts)), np.uint32)
    high = np.empty_like(low)
    i = 0
    while i < len(counts):  # as many sets at once as stay in the CPU's cache
        j = max(i + 1, int(np.searchsorted(begins, begins[i] + 4096)))
        e = elements[begins[i] : begins[j - 1] + counts[j - 1]][None, :]
        x = (e ^ flip) * factor
        at = begins[i:j] - begins[i]
        low[:, i:j] = np.minimum.reduceat(x, at, axis=1)
        high[:, i:j] = np.maximum.reduceat(x, at, axis=1)
        i = j
    a = (low.astype(np.uint64) << np.uint64(32)) | high
    key = mix(mix(a[0::2] + np.arange(bands, dtype=np.uint64)[:, None] * _M1) * np.uint64(3) + a[1::2])
    return key.T.view(np.int64)


def set_keys(elements: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 64-bit key of every non-empty set, whatever the order of its elements."""
    begins = np.cumsum(counts) - counts
    return (np.add.reduceat(mix(elements.astype(np.uint64) + np.uint64(1)), begins) ^ counts.astype(np.uint64)).view(np.int64)


def _lists(values: np.ndarray, ends: np.ndarray, there: np.ndarray) -> pa.ListArray:
    """Lists of 32- or 64-bit values; null where not `there` (these must have no values)."""
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32), mask=np.append(~there, False)), pa.array(values))


def signature_table(df: DataFrame, id_col: str, text_col: str, k: int, bands: int) -> DataFrame:
    """(id, set_key, n, bands) of every row with a non-empty set of n elements. In the rows of a class that a task has seen before, the bands are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for batch in slices(whole, 1, 4 << 20):
                elements, counts = shingle_sets(batch.column(1).to_pylist(), k)
                there = np.flatnonzero(counts)
                if not len(there):
                    continue
                counts = counts[there]
                keys = set_keys(elements, counts)
                _, first = np.unique(keys, return_index=True)
                fresh = np.zeros(len(keys), bool)
                fresh[first] = True
                fresh &= np.fromiter((x not in seen for x in keys.tolist()), bool, len(keys))
                if len(seen) > SEEN:
                    seen.clear()  # what is handed on twice is joined to one class later
                seen.update(keys[fresh].tolist())
                use = np.repeat(fresh, counts)
                band = signatures(elements[use], counts[fresh], bands) if fresh.any() else np.zeros((0, bands), np.int64)
                lists = _lists(np.ascontiguousarray(band).ravel(), np.append(0, np.cumsum(fresh * bands)), fresh)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(there)), pa.array(keys), pa.array(counts.astype(np.int64)), lists], ["id", "set_key", "n", "bands"])

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).where("id is not null and t is not null")
    fields = [("id", rows.schema["id"].dataType), ("set_key", T.LongType()), ("n", T.LongType()), ("bands", T.ArrayType(T.LongType()))]
    return rows.mapInArrow(run, T.StructType([T.StructField(*f) for f in fields]))


def candidate_classes(table: DataFrame, threshold: float) -> DataFrame:
    """(a, b, unit): pairs of classes, a < b, that share a band and whose sizes allow the similarity, each with the unit of its most populous bucket.

    One exchange by bucket serves the joining of repeated classes and the count of a bucket's classes. What is alone in
    its bucket ends there. A class in a bucket of g blocks goes to g units, those of its block with each of the others.
    """
    rows = table.where("bands is not null").select("set_key", "n", F.explode("bands").alias("bucket"))
    rows = rows.repartition("bucket").groupBy("bucket", "set_key").agg(F.max("n").alias("n"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1").select(F.col("bucket").alias("full"), "m")
    met = rows.join(sizes, F.col("bucket") == F.col("full")).drop("full")
    blocks = F.ceil(F.col("m") / BLOCK)
    met = met.withColumn("own", F.pmod(F.hash("set_key"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
    met = met.select("bucket", "m", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "set_key", "n")
    met = written(met, "neardup-units")
    unit = ["bucket", "p", "q"]
    left = met.where("own = p").select(*unit, "m", F.col("set_key").alias("x"), F.col("n").alias("nx"))
    right = met.where("own = q").select(*unit, F.col("set_key").alias("y"), F.col("n").alias("ny"))
    pairs = left.join(right, unit).where("x != y and (p != q or x < y)").where(F.least("nx", "ny") >= threshold * F.greatest("nx", "ny"))
    pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.struct("m", F.xxhash64(*unit).alias("unit")).alias("u"))
    return pairs.groupBy("a", "b").agg(F.max("u").alias("u")).select("a", "b", "u.unit")


def _named(id_col: str = "id") -> Column:
    return F.concat_ws("|", F.col(id_col).cast("string"), F.col("set_key").cast("string"))


def _pack(elements: np.ndarray) -> bytes:
    """A sorted set as the bytes of its differences, highest bytes first, so that an exchange can compress them."""
    return np.diff(elements, prepend=np.uint32(0)).astype(">u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view(">u4").ravel(), dtype=np.uint32)


def element_table(df: DataFrame, id_col: str, text_col: str, k: int, needed: DataFrame) -> DataFrame:
    """(set_key, elements) of the classes needed(set_key, id), made from the texts of these ids; repeated rows may repeat a class."""
    bits = screen(needed, _named())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[str, int]] = set()
        for whole in batches:
            for batch in slices(whole, 1, 4 << 20):
                elements, counts = shingle_sets(batch.column(1).to_pylist(), k)
                there = np.flatnonzero(counts)
                if not len(there):
                    continue
                counts = counts[there]
                keys = set_keys(elements, counts).tolist()
                ends = np.cumsum(counts)
                if len(seen) > SEEN:
                    seen.clear()
                out = []
                for key, end, n, name in zip(keys, ends.tolist(), counts.tolist(), batch.column(0).take(pa.array(there)).to_pylist()):
                    if (name, key) not in seen and passes(bits.value, f"{name}|{key}"):
                        seen.add((name, key))
                        out.append((name, key, _pack(elements[end - n : end])))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.binary()))], ["name", "set_key", "elements"])

    rows = df.select(F.col(id_col).cast("string").alias("name"), F.col(text_col).alias("t")).where("name is not null and t is not null")
    made = rows.mapInArrow(run, "name string, set_key bigint, elements binary")
    return made.join(needed.select("set_key", F.col("id").cast("string").alias("name")), ["set_key", "name"]).select("set_key", "elements")


def similar_classes(table: DataFrame, threshold: float, df: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """Pairs (a, b) of classes whose sets have a Jaccard similarity of at least the threshold."""
    pairs = written(candidate_classes(table, threshold), "neardup-pairs")
    used = pairs.select("unit", F.explode(F.array("a", "b")).alias("set_key")).distinct()
    classes = table.where("bands is not null").groupBy("set_key").agg(F.min("id").alias("id"))
    needed = written(classes.join(used.select("set_key").distinct(), "set_key"), "neardup-needed")
    sets = element_table(df, id_col, text_col, k, needed)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held = None, {}
        for batch in batches:
            found: list[tuple[int, int]] = []
            for u, a, b, data in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
                if u != unit:
                    unit, held = u, {}
                if b is None:
                    held[a] = _unpack(data.as_buffer())
                else:
                    x, y = held[a], held[b]
                    if len(y) < len(x):
                        x, y = y, x
                    at = np.searchsorted(y, x)
                    shared = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                    if shared >= threshold * (len(x) + len(y) - shared):
                        found.append((a, b))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

    rows = used.join(sets, "set_key").select("unit", F.col("set_key").alias("a"), F.lit(None).cast("bigint").alias("b"), "elements")
    rows = rows.unionByName(pairs.select("unit", "a", "b", F.lit(None).cast("binary").alias("elements")))
    rows = rows.repartition("unit").sortWithinPartitions("unit", F.col("b").asc_nulls_first())  # a unit's sets, then its pairs
    return rows.mapInArrow(check, "a bigint, b bigint")


def near_duplicates(df: DataFrame, id_col: str, text_col: str, k: int = 5, threshold: float = 0.8, bands: int = BODY_BANDS) -> DataFrame:
    """Pairs (doc_a, doc_b), doc_a < doc_b, of different ids whose sets are at least that similar."""
    table = written(signature_table(df, id_col, text_col, k, bands), "neardup-signatures")
    members = table.select("set_key", "id").distinct()
    a, b = members.toDF("a", "x"), members.toDF("b", "y")
    apart = similar_classes(table, threshold, df, id_col, text_col, k).join(a, "a").join(b, "b").select("x", "y")
    copies = members.toDF("a", "x").join(members.toDF("a", "y"), "a").where("x < y").select("x", "y")
    pairs = apart.where("x != y").unionByName(copies)
    return pairs.select(F.least("x", "y").alias("doc_a"), F.greatest("x", "y").alias("doc_b")).distinct()


def duplicate_groups(df: DataFrame, id_col: str, text_col: str, k: int = 5, threshold: float = 0.8, bands: int = BODY_BANDS) -> DataFrame:
    """One row (id, class_id, links) per id: the connected group it belongs to, named by its least id, and its number of similar classes.

    Only classes are linked, so a group of exact copies is one node. Labels spread over the links, each round by one
    aggregation; every round is written to the shared folder, and the labels also hop over their own label, so the
    number of rounds grows with the logarithm of a chain's length.
    A text with fewer than k words has no set: equal ones are one class, and a null text is a class of its own.
    """
    table = written(signature_table(df, id_col, text_col, k, bands), "neardup-signatures")
    members = table.select("set_key", F.col("id").alias(id_col)).distinct()
    links = similar_classes(table, threshold, df, id_col, text_col, k)
    links = written(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "neardup-links")
    labels = written(links.select(F.col("a").alias("v")).distinct().select("v", F.col("v").alias("label")), "neardup-labels")
    while True:
        offers = links.join(labels.toDF("b", "label"), "b").select(F.col("a").alias("v"), "label")
        step = labels.unionByName(offers).groupBy("v").agg(F.min("label").alias("label"))
        hop = labels.toDF("label", "far")
        step = step.join(hop, "label", "left").select("v", F.least("label", F.coalesce("far", "label")).alias("label"))
        step = written(step, "neardup-labels")
        changed = step.join(labels.toDF("v", "old"), "v").where("label != old").limit(1).count()
        labels = step
        if not changed:
            break
    degree = links.groupBy("a").agg(F.count("*").alias("links")).withColumnRenamed("a", "set_key")
    out = members.join(labels.withColumnRenamed("v", "set_key"), "set_key", "left").join(degree, "set_key", "left")
    out = out.select(id_col, F.coalesce("label", "set_key").alias("label"), F.coalesce("links", F.lit(0)).alias("links"))
    rest = df.where(F.col(id_col).isNotNull()).select(id_col, F.when(F.col(text_col).isNotNull(), F.xxhash64(text_col)).alias("h"))
    rest = rest.groupBy(id_col).agg(F.max("h").alias("h")).join(members.select(id_col).distinct(), id_col, "left_anti")
    rest = rest.select(id_col, F.coalesce("h", F.xxhash64(F.lit("null"), id_col)).alias("label"), F.lit(0).cast("bigint").alias("links"))
    rows = written(out.unionByName(rest), "neardup-groups")
    return rows.join(rows.groupBy("label").agg(F.min(id_col).alias("class_id")), "label").select(id_col, "class_id", "links")
