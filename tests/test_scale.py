"""Hot keys, extra columns and partitioning: one key with a third of the rows changes no result."""


from foliate.operators import dataflow, ledger, recall


def test_hot_item_in_replay(spark, tmp_path):
    rows = spark.range(0, 9000).selectExpr("cast(id % 8 as int) + 1 as run_no", "if(id % 3 = 0, 'hot', concat('k', id % 500)) as item_key", "concat('v', id % 4) as version", "timestamp_micros(id) as seen_at")
    commits = rows.where("run_no % 2 = 1").selectExpr("run_no", "item_key", "version", "seen_at as committed_at")
    got = ledger.replay_runs(ledger.LedgerStore(spark, f"file://{tmp_path}/log"), rows, commits)
    assert got.count() == got.select("run_no", "item_key").distinct().count() > 0
    state: dict = {}
    want = set()
    offers, done = {}, {}
    for r in rows.collect():
        key = (r.run_no, r.item_key)
        if key not in offers or (r.seen_at, r.version) > offers[key]:
            offers[key] = (r.seen_at, r.version)
        if r.run_no % 2 and (key not in done or (r.seen_at, r.version) > done[key]):
            done[key] = (r.seen_at, r.version)
    for run in range(1, 9):
        for (n, item), (_, version) in offers.items():
            if n == run and state.get(item) != version:
                want.add((run, item, version))
        for (n, item), (_, version) in done.items():
            if n == run:
                state[item] = version
    assert {(r.run_no, r.item_key, r.version) for r in got.collect()} == want


def test_last_record_of_a_hot_key(spark):
    log = spark.range(0, 20000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as k", "id as o", "id * 2 as v")
    got = dataflow.last_wins(log, "k", ["o"])
    assert got.where("k = 'hot'").collect()[0].v == 2 * 19998 and got.count() == log.select("k").distinct().count()


def test_results_do_not_depend_on_partitions(spark):
    texts = spark.range(0, 300).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as key", "concat_ws(' ', 'a', id % 7, 'b', id % 11) as text", "id as token")
    target = texts.where("token % 2 = 0")
    results = [sorted(tuple(r) for r in recall.coverage(texts.repartition(n), target.repartition(n)).collect()) for n in (1, 8)]
    assert results[0] == results[1] and len(results[0]) == texts.select("key").distinct().count()
    plan = recall.coverage(texts, target)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "BroadcastNestedLoop" not in plan


def test_filters_reach_the_scan(spark, data):
    from foliate.plans import core_queries

    plan = "".join(df._jdf.queryExecution().toString() for df in (core_queries.p4_offers(spark, data), core_queries.p4_commits(spark, data)))
    assert "ReadSchema: struct<run_no:int,doc_id:string,source_sha256:string,scanned_at:timestamp_ntz>" in plan
    assert "outline" not in plan.split("== Physical Plan ==")[-1]
