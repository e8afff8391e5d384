"""Filters, views, changes, lag, corroboration, reports and generators on small cases."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderweave import schemas as S
from orderweave.operators import corroborate, counts, filters, lag, mutate, records, views
from orderweave.operators.ordering import ordered_index, running_total
from orderweave.session import materialize, scratch
from orderweave.sources import generate, reports
from orderweave.sources.snapshots import LogSchemaError, SnapshotStore
from orderweave.sources.topics import TopicSpec, kafka_rows, replay_options, sink_options, source_options


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_wildcards_are_literal(spark):
    df = spark.createDataFrame([("a%b",), ("axb",), ("a_b",)], "t string")
    assert [r.t for r in filters.text_contains(df, "t", "%").collect()] == ["a%b"]
    assert [r.t for r in filters.text_contains(df, "t", "_").collect()] == ["a_b"]


def test_filters_reach_the_scan(spark, tables):
    stored = materialize(tables.request(), "pushed")
    text = plan(filters.eligible_requests(stored).select("request_id"))
    assert "PushedFilters: [In(result, [10,20])]" in text
    assert "ReadSchema: struct<request_id:bigint,result:int>" in text


def test_counts_on_an_empty_table_are_null(spark):
    assert tuple(counts.request_count(spark.createDataFrame([], S.REQUEST)).first()) == (None,) * 5
    assert corroborate.count_reconcile(spark.createDataFrame([], S.REQUEST)).first().reconciled


def test_unknown_results_break_the_reconciliation(spark):
    rows = [(1, 1, 1, 1, 10, r) for r in (10, 20, 30, 99, 7, None)]
    row = corroborate.count_reconcile(spark.createDataFrame(rows, S.REQUEST)).first()
    assert (row.total, row.bucket_sum, row.nbr_unknown, row.reconciled) == (6, 6, 2, False)


@pytest.mark.parametrize("amount", [0, 1001])
def test_refill_range(tables, amount):
    with pytest.raises(ValueError):
        mutate.refill_inventory(tables.inventory(), amount)
    with pytest.raises(ValueError):
        mutate.refill_balances(tables.person(), amount)


def test_bad_arguments(spark, tables):
    with pytest.raises(ValueError):
        mutate.reset_results(tables.request(), 11)
    with pytest.raises(ValueError):
        views.page_requests(tables.request(), "qty", size=7)
    with pytest.raises(ValueError):
        generate.gen_requests(spark, tables.person(), tables.product(), 0, 5)
    with pytest.raises(ValueError):
        generate.gen_requests(spark, tables.person().where("false"), tables.product(), 5, 5)
    with pytest.raises(ValueError):
        generate.gen_inventory(tables.product(), 0)
    with pytest.raises(ValueError):
        reports.write_report(tables.inventory(), "/nowhere", "pdf")


def test_first_valid_copy_wins(spark):
    new = spark.createDataFrame([(1, 5, 9, 1), (2, 5, 1, 1), (3, 5, 1, 2), (4, 6, 1, None), (5, 7, 1, 1)],
                                "seq int, id long, parent long, qty int")
    existing = spark.createDataFrame([(7,)], "id long")
    parents = {"parent": spark.createDataFrame([(1,)], "parent long")}
    got = mutate.insert_with_constraints(new, existing, "id", "seq", ["qty"], parents)
    assert {r.seq: r.status for r in got.collect()} == {
        1: "missing_parent", 2: "accepted", 3: "duplicate_in_batch", 4: "null_qty", 5: "duplicate_key"}


def test_last_change_wins(spark):
    table = spark.createDataFrame([(1, "a"), (2, "b")], "id long, t string")
    changes = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (3, "z", 1)], "id long, t string, at int")
    got = {r.id: (r.t, r.status) for r in mutate.update_by_id(table, changes, "id", order="at").collect()}
    assert got == {1: ("y", "updated"), 2: ("b", "unchanged"), 3: ("z", "not_found")}


def test_pages_cover_the_table_once(spark, tables):
    view = views.inventory_view(tables.inventory(), tables.product())
    pages = [[r.inventory_id for r in views.page_inventories(view, "qty", number=n, size=15).collect()] for n in range(14)]
    together = [i for p in pages for i in p]
    assert together == [r.inventory_id for r in views.page_inventories(view, "qty", size=-1).collect()]


def test_pages_by_rank(spark):
    """Ties, nulls, repeated keys, pages across ranges and behind the end; nothing gathers the rows before a page."""
    rows = [(i % 90, i % 5 if i % 7 else None, f"t{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "k long, o int, t string").repartition(3)
    for descending in (False, True):
        want = [(r.o, r.k) for r in views.page(df, "o", "k", 0, -1, descending).collect()]
        got = [views.page(df, "o", "k", n, 45, descending) for n in range(6)]
        assert [(r.o, r.k) for page in got for r in page.collect()] == want
        assert got[5].count() == 0
    plan = got[4]._jdf.queryExecution().toString()
    assert "Offset" not in plan and "Limit" not in plan
    assert views.page(df.where("false"), "o", "k", 0, 5).count() == 0


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_ordered_index_does_not_depend_on_the_cells(spark, width):
    df = spark.createDataFrame([("a" if i % 3 else "b", i * 7 - 50) for i in range(60)], "k string, o long")
    got = ordered_index(df, ["k"], "o", width=width).collect()
    for key in "ab":
        mine = sorted(r.o for r in got if r.k == key)
        assert {r.o: r.idx for r in got if r.k == key} == {o: i for i, o in enumerate(mine)}


@pytest.mark.parametrize("width", [1, 2, 1000])
def test_gaps_do_not_depend_on_the_cells(spark, width):
    df = spark.createDataFrame([("a", s) for s in (1, 2, 2, 5, 9, 9, 9)] + [("b", 4)], "k string, s int")
    got = {tuple(r) for r in corroborate.sequence_gaps(df, "k", "s", width).collect()}
    assert got == {("a", "duplicate", 2, 2, 2), ("a", "duplicate", 9, 9, 3), ("a", "gap", 3, 4, 2), ("a", "gap", 6, 8, 3)}


def test_gaps_of_a_hot_sparse_key(spark):
    """Values far apart on one key: no task reads much more than a range of rows."""
    df = spark.range(4000).select(F.lit(1).alias("k"), (F.col("id") * 10**12).alias("s"))
    got = corroborate.sequence_gaps(df.unionByName(spark.createDataFrame([(None, 3), (None, 5)], "k int, s long")), "k", "s", 100)
    rows = got.collect()
    assert len(rows) == 4000 and {r.n for r in rows if r.k == 1} == {10**12 - 1}
    assert [tuple(r) for r in rows if r.k is None] == [(None, "gap", 4, 4, 1)]


def lag_set(spark):
    """Three partitions of ten records; two groups with their own commits and thresholds."""
    rows = [("t", p, 10) for p in range(3)]
    end = spark.createDataFrame(rows, "topic string, partition_id int, end_offset long")
    committed = spark.createDataFrame(
        [("group-1", "t", p, o) for p, o in enumerate((5, 2, 0))] + [("group-2", "t", p, o) for p, o in enumerate((1, 4, 6))],
        "group_id string, topic string, partition_id int, committed_offset long")
    threshold = spark.createDataFrame([("group-1", 3), ("group-2", 4)], "group_id string, threshold long")
    return committed, end, threshold


def test_lag_and_alerts(spark):
    committed, end, threshold = lag_set(spark)
    rows = lag.consumer_lag(committed, end)
    assert {(r.group_id, r.partition_id): r.lag for r in rows.collect()} == {
        ("group-1", 0): 5, ("group-1", 1): 8, ("group-1", 2): 10, ("group-2", 0): 9, ("group-2", 1): 6, ("group-2", 2): 4}
    alerts = lag.lag_alerts(rows, threshold).collect()
    assert sorted((r.group_id, r.partition_id) for r in alerts) == [
        ("group-1", 0), ("group-1", 1), ("group-1", 2), ("group-2", 0), ("group-2", 1)]
    assert lag.lag_alerts(rows, threshold.where("false")).count() == 0


def test_advice_is_kept_in_its_bounds(spark):
    total = spark.createDataFrame([("a", 0), ("b", 1001), ("c", 10**9)], "group_id string, total_lag long")
    assert {r.group_id: r.replicas for r in lag.scale_advice(total).collect()} == {"a": 1, "b": 2, "c": 10}


def test_lag_of_a_running_query():
    progress = {"sources": [{"endOffset": '{"t":{"0":4,"1":9}}', "latestOffset": {"t": {"0": 10, "1": 9}}}]}
    assert [(r["partition_id"], r["lag"]) for r in lag.progress_lag(progress, "g")] == [(0, 6), (1, 0)]


def test_offsets_behind_the_end_read_nothing(spark):
    stored = spark.createDataFrame([("t", 0, i) for i in range(5)], "topic string, partition_id int, offset_id long")
    wanted = spark.createDataFrame([("t", 0, 99)], "topic string, partition_id int, requested_offset long")
    start = records.clamped_start(wanted, records.log_end(stored))
    assert start.first().start_offset == 5
    assert records.replay_from_offsets(stored, start).count() == 0


def test_unkeyed_records_have_no_key(tables):
    routed = records.route_by_key(tables.request(), 8, keyed=False)
    assert routed.where("msg_key IS NOT NULL").count() == 0
    assert routed.select("partition_id").distinct().count() == 8


def test_headers(spark):
    df = records.tag_batch(spark.range(1), "b")
    row = df.select(records.header("batch-id").alias("b"), records.header("replay-id").alias("r")).first()
    assert tuple(row) == ("b", None)


def test_snapshot_faults_are_found(spark):
    before = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id long, t string")
    after = spark.createDataFrame([(2, None), (3, "x"), (4, None)], "id long, t string")
    assert {tuple(r) for r in corroborate.snapshot_compare(before, after, "id").collect()} == {
        (1, "removed"), (3, "changed"), (4, "added")}
    left, right = (corroborate.state_checksum(df, "id", ["t"], 2) for df in (before, after))
    assert {r.bucket for r in corroborate.checksum_diff(left, right).collect()} == {0, 1}
    again = corroborate.state_checksum(before.orderBy(F.desc("id")), "id", ["t"], 2)
    assert corroborate.checksum_diff(left, again).count() == 0


def test_hash_tree_reads_differing_branches_only(spark):
    """One changed row in 50,000: one node of each level differs, and below the first level only its 256 children are read."""
    before = spark.range(50_000).select(F.col("id"), (F.col("id") * 7).alias("v")).repartition(3)
    after = before.withColumn("v", F.when(F.col("id") == 31_337, F.lit(0)).otherwise(F.col("v")))
    assert [corroborate.tree_depth(n) for n in (0, 16_384, 16_385, 10**9, 10**13)] == [1, 1, 2, 3, 5]
    left, right = (corroborate.hash_tree(df, "id", ["v"], 2) for df in (before, after))
    assert [tuple(r) for r in corroborate.tree_diff(left, right).collect()] == [(31_337, "changed")]
    levels = {r.level: (r.read, r.differing) for r in corroborate.tree_reads(left, right).collect()}
    assert levels[1] == (256, 1) and levels[2][0] <= 256 and levels[2][1] == 1
    assert corroborate.tree_diff(left, left).count() == 0


def test_hash_tree_of_odd_rows(spark):
    before = spark.createDataFrame([(None, "n"), (1, "a"), (2, None), (3, "")], "id long, t string")
    after = spark.createDataFrame([(None, "m"), (2, ""), (3, ""), (4, "d")], "id long, t string")
    trees = [corroborate.hash_tree(df, "id", ["t"], 1) for df in (before, after, before.where("false"))]
    assert {tuple(r) for r in corroborate.tree_diff(*trees[:2]).collect()} == {
        (None, "changed"), (1, "removed"), (2, "changed"), (4, "added")}
    assert {tuple(r) for r in corroborate.tree_diff(trees[2], trees[0]).collect()} == {
        (i, "added") for i in (None, 1, 2, 3)}
    assert corroborate.tree_diff(trees[2], trees[2]).count() == 0


@pytest.mark.parametrize("media", ["json", "xml", "csv"])
def test_report_round_trip(spark, tables, media):
    path = scratch(spark, media)
    view = views.inventory_view(tables.inventory(), tables.product())
    reports.write_report(view, path, media, title="")
    body = reports.read_report(spark, path, media)
    assert sorted(map(tuple, body.collect())) == sorted(map(tuple, view.collect()))
    if media == "json":
        assert tuple(spark.read.json(f"{path}/header").select("title", "sub-title").first()) == (
            reports.TITLE, reports.SUB_TITLE)
        assert len(spark.read.json(f"{path}/footer").first().date) == 19


def test_generated_requests(spark, tables):
    fresh = generate.gen_requests(spark, tables.person(), tables.product(), 500, 50)
    rows = fresh.collect()
    assert len(rows) == 500 and {r.qty for r in rows} <= set(range(1, 51))
    assert {(r.operation, r.result) for r in rows} == {(10, 10)}
    persons = {r.person_id for r in tables.person().collect()}
    assert {r.person_id for r in rows} <= persons and len({r.person_id for r in rows}) > 100
    again = generate.gen_requests(spark, tables.person(), tables.product(), 500, 50)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again.collect()))
    appended = generate.gen_requests(spark, tables.person(), tables.product(), 5, 5, existing=fresh)
    assert sorted(r.request_id for r in appended.collect()) == list(range(505))
    assert generate.gen_requests(spark, tables.person(), tables.product(), 5, 5, existing=fresh, replace=True).count() == 5


def test_sparse_parents_are_drawn_without_one_task(spark):
    """Ids far apart: every id in a value cell of its own would gather all rows in one task."""
    person = spark.range(300).select((F.col("id") * 10**9 - 5).alias("person_id"))
    product = spark.range(7).select((F.col("id") * 10**15).alias("product_id"))
    drawn = generate.gen_requests(spark, person, product, 2000, 5)
    assert drawn.select("person_id").distinct().count() > 250 and drawn.select("product_id").distinct().count() == 7
    at = running_total(person, ["person_id"], "at").orderBy("person_id").collect()
    assert [r.at for r in at] == list(range(300))


def test_draws_are_uniform(spark):
    words = spark.range(20000).select(generate.word(F.col("id"), 3).alias("w"))
    n = [r["count"] for r in words.groupBy(generate.draw("w", 10).alias("d")).count().collect()]
    assert len(n) == 10 and min(n) > 1700 and max(n) < 2300


def test_drawing_is_not_repeated_in_a_filter(spark):
    """A join on a draw that may be null gets a test for nulls with the whole mix written out below the projections."""
    person = spark.range(300).select(F.col("id").alias("person_id"))
    product = spark.range(7).select(F.col("id").alias("product_id"))
    for drawn in (generate.seed_requests(spark, person, product, 5), generate.gen_requests(spark, person, product, 40, 5)):
        plan = drawn._jdf.queryExecution().optimizedPlan().toString()
        filters = [line for line in plan.splitlines() if "Filter" in line]
        assert "shiftright" in plan and not [line for line in filters if "shiftright" in line]
        assert drawn.count() == 40


def test_seed_dataset(spark):
    data = generate.gen_seed_dataset(spark)
    assert {k: df.count() for k, df in data.items()} == {"person": 10, "product": 10, "inventory": 10, "request": 400}
    assert data["person"].select("balance").distinct().first()[0] == Decimal("2000.00")
    groups = data["request"].groupBy(F.expr("request_id div 8")).agg(F.count_distinct("product_id").alias("n")).collect()
    assert len(groups) == 50 and {g.n for g in groups} == {1}


def test_store_shows_whole_commits_only(spark):
    store = SnapshotStore(spark, scratch(spark, "store"))
    one, two = spark.range(1), spark.range(2)
    assert store.version() == 0 and store.commit("a", {"x": one, "y": one})
    assert not store.commit("a", {"x": two})
    store.stage("x", two)
    assert store.load("x").count() == 1
    assert store.commit("b", {"x": two}, {"log": one}) and store.version() == 2
    assert (store.load("x").count(), store.load("y").count(), store.load_log("log").count()) == (2, 1, 1)
    with pytest.raises(Exception):
        store.publish(2, "c", {}, {})


def test_half_made_commit_is_neither_read_nor_in_the_way(spark):
    store, one = SnapshotStore(spark, scratch(spark, "crash")), spark.range(1)
    spark.range(1).write.parquet(f"{store.root}/commits/000000000001-gone/_temporary/0")
    spark.range(5).write.parquet(f"{store.root}/logs/log/part=gone/_temporary/0")
    assert store.version() == 0 and not store.committed("a")
    assert store.load_log("log", lambda: spark.range(0)).count() == 0
    assert store.commit("a", {"x": one}, {"log": one}) and store.version() == 1
    assert store.load("x").count() == store.load_log("log").count() == store.added_by("a", "log").count() == 1


@pytest.mark.parametrize("bad", [
    {"name": " "}, {"name": "__consumer_offsets"}, {"name": "a b"}, {"name": "a", "dead_letter": "_schemas"},
    {"name": "a", "partitions": 0}, {"name": "a", "retry_attempts": 0}, {"name": "a", "retry_interval_ms": 0},
])
def test_topic_specs_are_checked(bad):
    with pytest.raises(ValueError):
        TopicSpec(**bad)


def test_topic_options(tables):
    spec = TopicSpec("orders", "orders-dlt", producer_options={"linger.ms": "1"}, consumer_options={"x": "y"})
    assert source_options(spec, "h:1", 10) | {"maxOffsetsPerTrigger": "10", "startingOffsets": "earliest"} == source_options(
        spec, "h:1", 10)
    assert source_options(spec, "h:1")["kafka.x"] == "y" and sink_options(spec, "h:1")["kafka.linger.ms"] == "1"
    assert replay_options({"t": {0: 5}})["startingOffsets"] == '{"t": {"0": 5}}'
    assert kafka_rows(records.outgoing(tables.request(), 8, "b")).columns == ["key", "value", "partition", "headers"]


def test_delete_all_is_refused_with_children(spark, tables):
    left, report = mutate.delete_all(tables.person(), "person_id", [tables.request()])
    assert left.count() == 150 and report.first().status == "refused"
    left, report = mutate.delete_all(tables.request(), "request_id", [])
    assert left.count() == 0 and left.schema == tables.request().schema and report.first().rows_after == 0


def test_parts_without_a_commit_concern_no_reader(spark):
    """Other columns, other types and a broken file lie in the log's folder; readers see the committed part's columns."""
    for _ in range(6):  # folder names are random, so their order is too
        store = SnapshotStore(spark, scratch(spark, "visible"))
        store.stage_part("log", spark.range(3).select(F.lit("x").alias("other")))
        store.stage_part("log", spark.range(3).select(F.col("id").cast("string").alias("a"), F.lit(2).alias("b")))
        spark.range(1).select(F.lit("no parquet").alias("value")).write.text(f"{store.root}/logs/log/broken.parquet")
        assert store.commit("a", added={"log": spark.range(2).select(F.col("id").alias("a"), F.lit(1).alias("b"))})
        store.stage_part("log", spark.range(9).select(F.lit(1).alias("c")))
        log = store.load_log("log")
        assert log.columns == ["a", "b"] and sorted(map(tuple, log.collect())) == [(0, 1), (1, 1)]


def test_a_part_of_another_schema_is_refused(spark):
    store, one = SnapshotStore(spark, scratch(spark, "schema")), spark.range(1)
    store.commit("r/1", {"x": one}, {"log": one})
    for other in (one.withColumn("more", F.lit(1)), one.select(F.col("id").cast("int"))):
        with pytest.raises(LogSchemaError):
            store.commit("r/2", {"x": spark.range(5)}, {"log": other})
    with pytest.raises(LogSchemaError):
        store.publish(2, "r/2", {}, {"unheard": store.stage_part("unheard", one)})
    assert store.version() == 1 and store.load("x").count() == 1
    assert store.commit("s/1", added={"log": spark.range(7).where("id > 4")}) and store.load_log("log").count() == 3
    assert store.load_log("log", since=1).count() == 2 and store.load_log("log", until=1).count() == 1
    assert store.load_log("log", run_id="r").count() == 1 and store.load_log("log", run_id="q").columns == ["id"]
    assert store.load("x", version=1).count() == 1
    with pytest.raises(KeyError):
        store.load_log("nothing")
    with pytest.raises(KeyError):
        store.load("x", version=9)
