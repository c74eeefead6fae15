"""Processing only new or changed records: a work-item ledger.

An item is a record's key with the version (content hash) that is to be processed. Its state is
*pending* (offered, not taken), *leased* (a worker has it until lease_until) or *done* (committed).

* ``offer``   adds versions that differ from the one last done; an item that is done in that version stays done.
* ``lease``   hands pending items to a worker and raises the item's fencing token.
* ``claim``   leases named items whatever their state (a forced repeat) and fences off whoever holds them.
* ``expire``  returns leases that ran out to pending, so work of a crashed run is taken up again.
* ``commit``  accepts a result only with the token of the item's present lease: a writer whose lease ran out and was
  given to another is stale and rejected, so no record is done twice. What is done is the version the writer read,
  which may be newer than the one offered; another version offered later makes the item pending again.
* ``result_path`` depends on key and version only: a retry writes to the same place and replaces what it left.

All are DataFrame-to-DataFrame; a state table is one row per key, so nothing is collected to the driver.
``LedgerStore`` keeps the state as numbered snapshots in a shared folder. Every writer writes to a path of its own; a
snapshot is in force once a marker of its number names that path, and a number has one marker. So a writer that is
refused, or dies at any point, leaves the state in force as it was.

``process_pending`` is a whole run of these steps. ``replay_runs`` drives them over the logs of past runs: per run it
offers what the run listed, leases what is pending, commits what the run's reports say and lets the rest expire.

Defined results: rows with a null key are no items; a null, empty or blank version can't be read and is no
offer; hashes are compared without regard to case, blanks around them and a leading ``sha256:``; of several
offers of a key the latest by ``seen_at`` counts (then, or where there is no such column, the greater version, so ties
are stable), and of several results of one lease the latest by ``finished_at`` likewise; repeated rows count once;
empty tables give empty tables; extra columns of any name are left out.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliate.session import written

PENDING, LEASED, DONE = "pending", "leased", "done"
CLAIMED = "!"  # ends the owner's name on a lease that was claimed and not handed out

STATE = T.StructType(
    [
        T.StructField("item_key", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("owner", T.StringType()),
        T.StructField("lease_until", T.LongType()),
        T.StructField("fence", T.LongType()),
        T.StructField("done_version", T.StringType()),
        T.StructField("offered_in", T.LongType()),
    ]
)


def hash_key(h: Column) -> Column:
    """A content hash in its one spelling; null where there is none."""
    return F.nullif(F.regexp_replace(F.lower(F.trim(h)), "^sha256:", ""), F.lit(""))


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE)


def _latest(rows: DataFrame, keys: list[str], at: str, name: str) -> DataFrame:
    """One version a key: the latest by column `at` where there is one, then the greatest. Combines before the shuffle."""
    order = [F.col(at)] if at in rows.columns else []
    return rows.groupBy(*keys).agg(F.max(F.struct(*order, F.col(name))).alias("m")).select(*keys, F.col(f"m.{name}").alias(name))


def offer(state: DataFrame, items: DataFrame, run: int = 0) -> DataFrame:
    """The state after offering items(item_key, version and, if known, seen_at) in a run. A changed version makes its item pending; its token stays.

    An offer whose latest version can't be read (null, empty, blank) is none, whatever older ones say.
    """
    extra = ["seen_at"] if "seen_at" in items.columns else []
    new = items.where("item_key is not null").select("item_key", F.coalesce(hash_key(F.col("version")), F.lit("")).alias("offered"), *extra)
    new = _latest(new, ["item_key"], "seen_at", "offered").where("offered != ''")
    joined = state.join(new, "item_key", "full")
    asked = F.col("offered").isNotNull()
    same = ~asked | ((F.col("state") != DONE) & F.col("offered").eqNullSafe(F.col("version")))
    done = asked & F.col("offered").eqNullSafe(F.col("done_version"))
    fresh = ~same & ~done
    return joined.select(
        "item_key",
        F.coalesce("offered", "version").alias("version"),
        F.when(done, DONE).when(fresh, PENDING).otherwise(F.col("state")).alias("state"),
        F.when(~fresh & ~done, F.col("owner")).alias("owner"),
        F.when(~fresh & ~done, F.col("lease_until")).alias("lease_until"),
        F.coalesce("fence", F.lit(0)).cast("long").alias("fence"),
        "done_version",
        F.when(asked, F.lit(run)).otherwise(F.col("offered_in")).cast("long").alias("offered_in"),
    )


def _leased(state: DataFrame, mine: Column, owner: Column, until: int) -> DataFrame:
    return state.select(
        "item_key",
        "version",
        F.when(mine, LEASED).otherwise(F.col("state")).alias("state"),
        F.when(mine, owner).otherwise(F.col("owner")).alias("owner"),
        F.when(mine, F.lit(until).cast("long")).otherwise(F.col("lease_until")).alias("lease_until"),
        F.when(mine, F.col("fence") + 1).otherwise(F.col("fence")).alias("fence"),
        "done_version",
        "offered_in",
    )


def lease(state: DataFrame, owner: str, now: int, seconds: int, share: tuple[int, int] = (0, 1), run: int | None = None) -> DataFrame:
    """Lease the pending items of a share (number, of) to owner; their tokens rise by one. With `run`, only those offered in it."""
    mine = (F.col("state") == PENDING) & (F.pmod(F.xxhash64("item_key"), F.lit(share[1])) == share[0])
    if run is not None:
        mine &= F.col("offered_in") == run
    return _leased(state, mine, F.lit(owner), now + seconds)


def claim(state: DataFrame, keys: DataFrame, owner: str, now: int, seconds: int) -> DataFrame:
    """Lease the items keys(item_key), whatever their state, but for those owner holds already; unknown keys become items without a version."""
    named = keys.select("item_key").where("item_key is not null").distinct().withColumn("_named", F.lit(True))
    rows = state.join(named, "item_key", "full").withColumn("fence", F.coalesce("fence", F.lit(0)).cast("long"))
    held = F.coalesce((F.col("state") == LEASED) & (F.col("owner").startswith(owner)), F.lit(False))
    return _leased(rows, F.coalesce("_named", F.lit(False)) & ~held, F.lit(owner + CLAIMED), now + seconds)


def expire(state: DataFrame, now: int) -> DataFrame:
    """Return leases that ran out to pending. Tokens stay, so that the late writer's one is passed by the next lease."""
    over = (F.col("state") == LEASED) & (F.col("lease_until") <= now)
    back = F.when(F.col("version").isNull() | F.col("version").eqNullSafe(F.col("done_version")), DONE).otherwise(PENDING)  # a forced repeat that failed changes nothing
    return state.select(
        "item_key",
        "version",
        F.when(over, back).otherwise(F.col("state")).alias("state"),
        F.when(~over, F.col("owner")).alias("owner"),
        F.when(~over, F.col("lease_until")).alias("lease_until"),
        "fence",
        "done_version",
        "offered_in",
    )


def commit(state: DataFrame, results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Commit results(item_key, version, fence and, if known, finished_at). Returns the new state and the rejected results.

    A result counts if it bears the token of the item's present lease and a version.
    """
    extra = ["finished_at"] if "finished_at" in results.columns else []
    got = results.select("item_key", hash_key(F.col("version")).alias("r_version"), F.col("fence").cast("long").alias("r_fence"), *extra)
    one = _latest(got.where("item_key is not null and r_version is not null and r_fence is not null"), ["item_key", "r_fence"], "finished_at", "r_version")
    held = state.where(F.col("state") == LEASED).select("item_key", F.col("fence").alias("r_fence"))
    refused = got.select("item_key", "r_version", "r_fence").distinct().join(held.where("r_fence is not null"), ["item_key", "r_fence"], "left_anti")
    rejected = refused.select("item_key", F.col("r_version").alias("version"), F.col("r_fence").alias("fence"))
    joined = state.join(one.withColumnRenamed("r_fence", "fence"), ["item_key", "fence"], "left")
    hit = F.col("r_version").isNotNull() & (F.col("state") == LEASED)
    new = joined.select(
        "item_key",
        F.when(hit, F.col("r_version")).otherwise(F.col("version")).alias("version"),
        F.when(hit, DONE).otherwise(F.col("state")).alias("state"),
        F.when(~hit, F.col("owner")).alias("owner"),
        F.when(~hit, F.col("lease_until")).alias("lease_until"),
        "fence",
        F.when(hit, F.col("r_version")).otherwise(F.col("done_version")).alias("done_version"),
        "offered_in",
    )
    return new, rejected


def result_path(root: str, item_key: Column, version: Column) -> Column:
    """Where an item's result goes: the same for every attempt at the same version."""
    name = F.sha2(F.concat_ws("\u0000", item_key, version), 256)
    return F.concat(F.lit(root.rstrip("/") + "/"), F.substring(name, 1, 2), F.lit("/"), name)


class LedgerStore:
    """Snapshots of a ledger's state in a folder that all executors share.

    A snapshot is a table under a path of its writer's own; the marker file of its number holds that path. A marker is
    made by a create that fails where the file exists, so of several successors of a snapshot one comes into force. The
    file system must do that create as one step (HDFS, local disks; object stores only with conditional writes).
    A writer that dies between making its marker and filling it leaves an empty one: it isn't in force, and the next
    writer removes it once it is older than GRACE seconds. A slow writer whose marker was removed finds that out by
    reading it back.
    """

    GRACE = 60

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _marker(self, n: int):
        return self._path(f"{self.root}/markers/{n}")

    def _named(self, n: int) -> str:
        """The path a marker names; empty where it isn't filled or isn't there."""
        if not self._fs.exists(self._marker(n)):
            return ""
        stream = self._fs.open(self._marker(n))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return text.strip() if text.endswith("\n") else ""

    def latest(self) -> int:
        """The number of the snapshot in force; 0 where there is none."""
        at = self._path(f"{self.root}/markers")
        if not self._fs.exists(at):
            return 0
        numbers = sorted((int(s.getPath().getName()) for s in self._fs.listStatus(at) if s.getPath().getName().isdigit()), reverse=True)
        return next((n for n in numbers if self._named(n)), 0)

    def read(self, n: int | None = None) -> DataFrame:
        """The state of snapshot n, by default of the one in force."""
        n = self.latest() if n is None else n
        return self.spark.read.schema(STATE).parquet(f"{self.root}/{self._named(n)}") if n else empty_state(self.spark)

    def write(self, state: DataFrame, base: int) -> int:
        """Put state in force as the successor of snapshot `base`; fails if another writer was faster."""
        n, name = base + 1, f"state/{base + 1:012d}-{uuid.uuid4().hex}"
        state.write.parquet(f"{self.root}/{name}")
        marker = self._marker(n)
        self._fs.mkdirs(marker.getParent())
        if self._fs.exists(marker) and not self._named(n):
            age = self._jvm.java.lang.System.currentTimeMillis() - self._fs.getFileStatus(marker).getModificationTime()
            if age > 1000 * self.GRACE:  # its writer died before it filled it
                self._fs.delete(marker, False)
        try:
            stream = self._fs.create(marker, False)  # fails where it exists: one writer wins
            try:
                stream.write(bytearray(f"{name}\n".encode()))
            finally:
                stream.close()
        except Exception as e:  # py4j wraps the file system's error
            raise RuntimeError(f"snapshot {n} is taken; read the state in force and repeat") from e
        if self._named(n) != name:
            raise RuntimeError(f"the marker of snapshot {n} was taken away; read the state in force and repeat")
        return n

    def prune(self, keep: int = 2) -> None:
        """Remove the tables of snapshots that are `keep` or more behind the one in force, and what refused writers left there."""
        at = self._path(f"{self.root}/state")
        last = self.latest()
        for s in self._fs.listStatus(at) if self._fs.exists(at) else ():
            if int(s.getPath().getName().split("-")[0]) <= last - keep:
                self._fs.delete(s.getPath(), True)


def _step(store: LedgerStore, change: Callable[[DataFrame], DataFrame], attempts: int = 5) -> DataFrame:
    """Put a changed state in force, anew on the state then in force if another writer was faster."""
    for n in range(attempts):
        base = store.latest()
        try:
            return store.read(store.write(change(store.read(base)), base))
        except RuntimeError:
            if n + 1 == attempts:
                raise
    raise AssertionError


def process_pending(store: LedgerStore, items: DataFrame, work: Callable[[DataFrame], DataFrame], owner: str, now: int, seconds: int, attempts: int = 5) -> DataFrame:
    """One run: offer items(item_key, version), lease what is pending, do the work, commit; returns the rejected results.

    work gets (item_key, version, fence) and returns the rows it finished. Its results are written before they are
    committed. Leases are held under a name of this run's own, so runs of one owner never take each other's items. If
    the work fails, the leases stay and run out, and a later run takes the items up again.
    """
    me = f"{owner}/{uuid.uuid4().hex}"
    state = _step(store, lambda s: lease(expire(offer(s, items), now), me, now, seconds), attempts)
    mine = state.where((F.col("state") == LEASED) & (F.col("owner") == me))
    results = written(work(mine.select("item_key", "version", "fence")).select("item_key", "version", "fence"), "ledger-results")
    refused: list[DataFrame] = []

    def settle(s: DataFrame) -> DataFrame:
        after, rejected = commit(s, results)
        refused[:] = [rejected]  # as judged by the state that comes into force
        return after

    _step(store, settle, attempts)
    return written(refused[0], "ledger-rejected")


def replay_runs(store: LedgerStore, offers: DataFrame, commits: DataFrame) -> DataFrame:
    """(run_no, item_key, version): the items that were pending when each run began, by driving the ledger over the logs of all runs.

    offers(run_no, item_key, version, seen_at), commits(run_no, item_key, version, committed_at). Runs follow one another
    by run_no, not by the time of writing. Each run lets former leases expire, offers its listing and leases what is
    pending of it. The log doesn't say which leases its writers held, so a key with a result but without a lease in that
    run is claimed (a repeat of a done item, or one the listing lacks). Results are committed under the tokens of these
    leases. What has no result expires when the next run begins, as after a failure or a crash.

    Both logs are reduced to one row per run and item first, which combines before the shuffle, and written by run, so a
    run reads its own part and an item that holds most of the log costs a row a run. A run's commits
    and the next run's offers and leases are one change of the state and so one snapshot; its joins are by key of the
    state, which has a row per item.
    """
    offered = offers.where("run_no is not null and item_key is not null").select("run_no", "item_key", F.coalesce(hash_key(F.col("version")), F.lit("")).alias("version"), "seen_at")
    offered = _latest(offered, ["run_no", "item_key"], "seen_at", "version").select("run_no", "item_key", "version", F.lit(True).alias("offered"))
    finished = commits.where("run_no is not null and item_key is not null").select("run_no", "item_key", hash_key(F.col("version")).alias("version"), "committed_at").where("version is not null")
    finished = _latest(finished, ["run_no", "item_key"], "committed_at", "version").select("run_no", "item_key", "version", F.lit(False).alias("offered"))
    log = written(offered.unionByName(finished), "ledger-log", "run_no")
    runs = [r.run_no for r in log.select("run_no").distinct().orderBy("run_no").collect()]  # one small row a run
    found = []
    results = None
    for run in runs:
        mine, done = (log.where((F.col("run_no") == run) & (F.col("offered") == kind)) for kind in (True, False))
        me = f"run {run}"

        def begin(s: DataFrame) -> DataFrame:
            s = s if results is None else commit(s, results)[0]  # what the run before finished
            return claim(lease(offer(expire(s, run), mine, run), me, run, 1, run=run), done, me, run, 1)

        state = _step(store, begin)
        found.append(state.where((F.col("state") == LEASED) & (F.col("owner") == me)).select(F.lit(run).alias("run_no"), "item_key", "version"))
        results = done.select("item_key", "version").join(state.where(F.col("state") == LEASED).select("item_key", "fence"), "item_key")
    if results is not None:
        _step(store, lambda s: commit(s, results)[0])
    if not found:
        return offered.where("false").select("run_no", "item_key", "version")
    return reduce(DataFrame.unionByName, found)
