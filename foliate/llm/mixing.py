"""Mixing sources to target weights: balanced sampling by the cube method.

Every document of a source is to be used x times on average, x being the source's share of the mixture's total divided
by the source's tokens: the whole part of x times for certain, and once more with the fractional part as inclusion
probability. Which documents get the extra copy is decided by the cube method: the vector of probabilities moves at
random, but only in the null space of the balancing constraints (the sum of tokens and the number of documents), until
each probability is 0 or 1. A step looks at three documents, since two constraints leave one free direction; it keeps
every document's expected number of copies and fixes at least one document. A flight ends with at most two documents
undecided.

Flights run side by side in blocks of a source, into which its documents fall by a hash: BLOCK on average, and as the
hash is even, no block is much larger (by the binomial law above 1.05 x BLOCK less than once in 10^11), whatever share
of the rows a source has; the few
undecided documents of the blocks fly again together, level by level, until one block is left. Its last two documents
are the landing: the rounding that leaves the sum of tokens nearest. So a source misses its tokens by less than a
document or two.

The total is the largest at which no document is used more than its source's max_repeats times, or a given lower one.

Defined results: sources are trimmed and in lower case; a null source, one without target or whose cap is below 1, and
targets without documents have share 0, and the others keep their proportions; documents without tokens are left out;
repeated texts under other ids are documents of their own, repeated rows of an id count once; empty tables give an
empty mixture; ties in size move by count alone. The draw depends on the seed and the ids only, not on partitioning.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foliate.llm.tokens import count_column
from foliate.session import written

BLOCK = 20_000
#: Largest number of sources; their totals are small tables of their own.
MAX_SOURCES = 100_000
_EDGE = 1e-9


def flight(size: np.ndarray, p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The probabilities after the flight: the sums of p and of size * p are kept, at most two lie between 0 and 1."""
    out, sizes = np.where(p <= _EDGE, 0.0, np.where(p >= 1 - _EDGE, 1.0, p)).tolist(), size.tolist()
    draws = iter(())
    active: list[int] = []
    queue = iter([i for i, x in enumerate(out) if 0 < x < 1])
    while True:
        while len(active) < 3:
            i = next(queue, None)
            if i is None:
                return np.asarray(out)
            active.append(i)
        a, b, c = (sizes[i] for i in active)
        u = (b - c, c - a, a - b) if not a == b == c else (1.0, -1.0, 0.0)
        up = down = float("inf")  # the farthest steps along u and against it
        for i, d in zip(active, u):
            x = out[i]
            if d > 0:
                up, down = min(up, (1 - x) / d), min(down, x / d)
            elif d < 0:
                up, down = min(up, -x / d), min(down, (x - 1) / d)
        draw = next(draws, None)
        if draw is None:
            draws = iter(rng.random(4096).tolist())
            draw = next(draws)
        step = up if draw * (up + down) < down else -down
        rest = []
        for i, d in zip(active, u):
            x = out[i] + step * d
            if x <= _EDGE:
                out[i] = 0.0
            elif x >= 1 - _EDGE:
                out[i] = 1.0
            else:
                out[i] = x
                rest.append(i)
        active = rest


def landing(size: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The undecided few rounded so that the sum of sizes, then the number, stays nearest."""
    out = p.copy()
    open_ = np.flatnonzero((p > 0) & (p < 1))
    if len(open_):
        a, q = size[open_], p[open_]
        out[open_] = min(product((0.0, 1.0), repeat=len(open_)), key=lambda x: (round(abs(float(((np.asarray(x) - q) * a).sum())), 6), abs(float((np.asarray(x) - q).sum())), x))
    return out


def _fly(key: tuple, table: pa.Table) -> pa.Table:
    source, block, blocks = (k.as_py() for k in key)
    order = np.lexsort((table["doc_key"].to_numpy(), table["draw"].to_numpy()))
    table = table.take(pa.array(order))
    size, p = table["n_tokens"].to_numpy().astype(float), table["p"].to_numpy()
    rng = np.random.default_rng([abs(int(table["draw"][0].as_py())), block])
    p = flight(size, p, rng)
    if blocks == 1:
        p = landing(size, p)
    return pa.table({"doc_key": table["doc_key"], "source": table["source"], "n_tokens": table["n_tokens"], "p": pa.array(p)})


def plan(counts: DataFrame, targets: DataFrame, total_tokens: float | None = None) -> DataFrame:
    """(source, n_docs, tokens, target_share, share, x): the share each source can have and the average uses of its documents."""
    name = F.lower(F.trim("source"))
    wanted = targets.where("source is not null and target_share > 0 and max_repeats >= 1").groupBy(name.alias("source")).agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    have = counts.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("tokens"))
    both = have.join(wanted, "source")
    one = Window.partitionBy(F.lit(1))  # one row per source: a small table
    every = F.sum("target_share").over(one)
    most = F.min(F.col("max_repeats") * F.col("tokens") / F.col("target_share")).over(one) * every
    total = most if total_tokens is None else F.least(most, F.lit(float(total_tokens)))
    share = F.col("target_share") / every
    x = F.least(share * total / F.col("tokens"), F.col("max_repeats").cast("double"))
    return both.select("source", "n_docs", "tokens", "target_share", share.alias("share"), x.alias("x"), "max_repeats")


def token_counts(documents: DataFrame, id_col: str, source_col: str, text_col: str, path: str) -> DataFrame:
    """(doc_key, source, n_tokens) of the documents with tokens, written once to the shared folder."""
    rows = documents.select(F.col(id_col).alias("doc_key"), F.lower(F.trim(F.col(source_col))).alias("source"), F.col(text_col).alias("text"))
    rows = rows.where("doc_key is not null and source is not null and text is not null and text != ''")
    return written(count_column(rows, ["doc_key", "source"], "text", path).where("n_tokens > 0").dropDuplicates(["doc_key"]), "mixing-counts")


def mixture(counts: DataFrame, targets: DataFrame, seed: int = 0, total_tokens: float | None = None) -> DataFrame:
    """(doc_key, source, n_tokens, copies) of every document that is used."""
    if targets.select(F.lower(F.trim("source"))).distinct().limit(MAX_SOURCES + 1).count() > MAX_SOURCES:  # before any window over them
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sources = written(plan(counts, targets, total_tokens), "mixing-plan")
    stats = sources.agg(F.max("n_docs").alias("most")).collect()[0]
    small = F.broadcast(sources.select("source", "n_docs", F.floor("x").alias("whole"), (F.col("x") - F.floor("x")).alias("p")))
    rows = counts.join(small, "source").withColumn("draw", F.xxhash64("doc_key", F.lit(seed)))
    kind = counts.schema["doc_key"].dataType.simpleString()
    blocks = F.ceil(F.col("n_docs") / BLOCK)
    flying = rows.select("doc_key", "source", "n_tokens", "p", "draw", blocks.alias("blocks"))
    done = None
    left = stats.most or 0
    while True:
        flying = flying.withColumn("block", F.pmod(F.shiftright("draw", 20), F.col("blocks")))
        flown = flying.groupBy("source", "block", "blocks").applyInArrow(_fly, f"doc_key {kind}, source string, n_tokens bigint, p double")
        flown = written(flown, "mixing-flight")
        fixed = flown.where("p = 0 or p = 1")
        done = fixed if done is None else done.unionByName(fixed)
        if left <= BLOCK:
            break
        left = -(-left // BLOCK) * 2
        counted = F.broadcast(flown.where("p > 0 and p < 1").groupBy("source").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")))
        flying = flown.where("p > 0 and p < 1").withColumn("draw", F.xxhash64("doc_key", F.lit(seed))).join(counted, "source")
    whole = F.broadcast(sources.select("source", F.floor("x").alias("whole")))
    return done.join(whole, "source").select("doc_key", "source", "n_tokens", (F.col("whole") + F.col("p")).cast("int").alias("copies")).where("copies > 0")


def shares(counts: DataFrame, targets: DataFrame, mixed: DataFrame) -> DataFrame:
    """(source, target_share, actual_share, n_docs, n_tokens, used_docs, used_copies, used_tokens) of every source with documents or a target."""
    name = F.lower(F.trim("source"))
    wanted = targets.where("source is not null").groupBy(name.alias("source")).agg(F.max("target_share").alias("target_share"))
    have = counts.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    used = mixed.groupBy("source").agg(F.count("*").alias("used_docs"), F.sum("copies").alias("used_copies"), F.sum(F.col("copies") * F.col("n_tokens")).alias("used_tokens"))
    rows = have.join(wanted, "source", "full").join(used, "source", "left")
    total = F.sum("used_tokens").over(Window.partitionBy(F.lit(1)))  # one row per source
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    actual = F.coalesce(F.col("used_tokens") / total, F.lit(0.0)).alias("actual_share")
    return rows.select("source", F.coalesce("target_share", F.lit(0.0)).alias("target_share"), actual, *map(zero, ["n_docs", "n_tokens", "used_docs", "used_copies", "used_tokens"]))
