"""Corner cases by hand, and brute force where SQL is not at hand."""

from __future__ import annotations

import random
from collections import Counter
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rollcall import functions as fn
from rollcall.operators import windows
from rollcall.operators import joins, latest, lookup, ordered, projection, routing, words
from rollcall.operators.skew import PART, HotKeys, hot_key_parts, spread
from rollcall.schemas import MEMBER, PAYMENT, WIDE_MEMBER
from rollcall.session import fresh_dir, shared_dir
from rollcall.sinks.row_client import ClientWriter
from rollcall.sinks.upsert_table import CellTable, UpsertTable
from rollcall.sources import decode, jdbc_query, kafka_options, read_raw_log, render_sql
from suite.transforms import word_pairs

MINUTE_MS = 60_000


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- JSON -------------------------------------------------------------------------------------------------------

KEPT = ['{"uid":"12","a":1}', "{}", ' {"a":1} ', '{"a":[1,{"b":"}]"}]}']
DROPPED = ["[1]", "12", '"s"', "null", "", None, "not json", '{"a":1', '{"a":1,}', '{"a":1} x', '{"a":1}}',
           '{"a":1}] x}', '{"a":1},{"b":2}', '{"a":1} {"b":2}', '[{"a":1}]']


def test_only_json_objects_are_kept(spark):
    log = spark.createDataFrame([("member", v) for v in KEPT + DROPPED], "topic string, value string")
    assert sorted(r.value for r in routing.json_records(log).collect()) == sorted(KEPT)


def test_ids_as_strings_or_numbers(spark):
    log = spark.createDataFrame(
        [('{"uid":"12","ad_id":"x"}',), ('{"uid":12}',), ('{"uid":"","unknown":1}',)], "value string")
    found = decode(log, MEMBER, bad_fields="bad").select("uid", "ad_id", "dn", "bad").collect()
    assert [tuple(r) for r in found] == [(12, None, None, 1), (12, None, None, 0), (None, None, None, 1)]


def test_json_text_leaves_nulls_out(spark):
    made = spark.sql("SELECT 1 AS a, CAST(NULL AS string) AS b").select(fn.json_text("a", "b").alias("v"))
    assert made.first().v == '{"a":1}'


def test_json_object_with_repeated_field(spark):
    row = spark.sql("""SELECT '{"a":"1","b":null}' AS v""").select(fn.json_object(F.col("v")).alias("m")).first()
    assert row.m == {"a": "1", "b": None}


# --- functions --------------------------------------------------------------------------------------------------

def test_addresses(spark):
    df = spark.createDataFrame([(607649792,), (-1950089216,), (None,)], "n int")
    assert [r[0] for r in df.select(fn.ipv4(F.col("n"))).collect()] == ["36.56.0.0", "139.196.0.0", None]


def test_money_rounds_ties_to_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (1234567.5,), (0.0,)], "x double")
    assert [r[0] for r in df.select(fn.money_text(F.col("x"))).collect()] == ["0.12", "0.38", "1234567.50", "0.00"]


def test_event_time_of_bad_text_is_null(spark):
    df = spark.createDataFrame([("1000",), ("x",), ("",), (None,), ("9223372036854775807",)], "v string")
    found = df.select(F.unix_millis(fn.epoch_ms_to_timestamp(F.col("v")))).collect()
    assert [r[0] for r in found] == [1000, None, None, None, None]


def test_md5_keeps_leading_zeros(spark):
    hashes = [r[0] for r in spark.range(2000).select(fn.md5_hex(F.col("id"))).collect()]
    assert all(len(h) == 32 for h in hashes) and any(h.startswith("0") for h in hashes)


# --- routing ----------------------------------------------------------------------------------------------------

def test_unknown_topics_are_facts_and_go_to_the_default_table(spark):
    log = spark.createDataFrame([("basead", "{}"), ("other", "{}"), (None, "{}")], "topic string, value string")
    facts, dimensions = routing.split_by_layer(log)
    assert facts.count() == 2 and dimensions.count() == 1
    named = log.select(routing.target_table(F.col("topic"))).collect()
    assert [r[0] for r in named] == ["dwd_basead", "dwd_membervip", "dwd_membervip"]


# --- joins ------------------------------------------------------------------------------------------------------

MEMBER_DDL = "uid int, dn string, register string, ts timestamp"
REGTYPE_DDL = ("uid int, dn string, appkey string, appregurl string, bdp_uuid string, createtime string, "
               "isranreg string, regsource string, websiteid string, ts timestamp")


def at(minute: float) -> str:
    return str(int(minute * MINUTE_MS))


def member_rows(spark, *pairs):
    df = spark.createDataFrame([(uid, "webA", at(m)) for uid, m in pairs], "uid int, dn string, register string")
    return df.withColumn("ts", fn.epoch_ms_to_timestamp(F.col("register")))


def regtype_rows(spark, *pairs):
    df = spark.createDataFrame(
        [(uid, "webA", f"k{m}", "u", "b", at(m), "-", "0", "0") for uid, m in pairs],
        "uid int, dn string, appkey string, appregurl string, bdp_uuid string, createtime string, "
        "isranreg string, regsource string, websiteid string")
    return df.withColumn("ts", fn.epoch_ms_to_timestamp(F.col("createtime")))


@pytest.mark.parametrize("hot_keys", [None, HotKeys(), HotKeys(rows_per_part=1)])
def test_left_join_in_ten_minute_windows(spark, hot_keys):
    member = member_rows(spark, (1, 1), (1, 2), (2, 3), (3, 12), (None, 4))
    regtype = regtype_rows(spark, (1, 5), (1, 6), (3, 5), (4, 5), (None, 4))
    joined = joins.join_regtype(member, regtype, hot_keys=hot_keys)
    assert values(joined, "uid", "register", "appkey") == sorted([
        (1, at(1), "k5"), (1, at(1), "k6"), (1, at(2), "k5"), (1, at(2), "k6"),
        (2, at(3), None), (3, at(12), None), (None, at(4), None)], key=repr)


def test_window_borders(spark):
    member = member_rows(spark, (1, 9.999), (1, 10))
    joined = joins.join_regtype(member, regtype_rows(spark, (1, 10.5)))
    assert values(joined, "register", "appkey") == sorted([(at(9.999), None), (at(10), "k10.5")], key=repr)


def test_rows_without_event_time_can_be_found(spark):
    member = spark.createDataFrame([(1, "webA", "x")], "uid int, dn string, register string")
    timed = member.withColumn("ts", fn.epoch_ms_to_timestamp(F.col("register")))
    assert joins.without_event_time(timed, "ts").count() == 1
    assert joins.in_window(timed, "ts").count() == 0


def brute_left_join(sides, keys):
    """Left join of lists of dicts by nested loops."""
    out = []
    for left in sides[0]:
        partial = [dict(left)]
        for side in sides[1:]:
            matches = [r for r in side if all(r[k] == left[k] and r[k] is not None for k in keys)]
            extra = [c for c in side[0] if c not in keys]
            partial = [p | ({c: m[c] for c in extra} if m else dict.fromkeys(extra))
                       for p in partial for m in (matches or [None])]
        out += partial
    return Counter(tuple(sorted(r.items())) for r in out)


@pytest.mark.parametrize("rows_per_part", [1, 3, 7, 1000])
def test_spread_keys_give_the_same_pairs(spark, rows_per_part):
    rng = random.Random(5)

    def side(count, name, copies):
        # A third of the rows has one key, and some rows are equal to each other.
        keys = [0 if i % 3 == 0 else rng.choice([1, 2, 3, 4, 5, None]) for i in range(count)]
        return [{"k": k, name: i // copies} for i, k in enumerate(keys)]

    sides = [side(60, "a", 2), side(45, "b", 3), side(30, "c", 1)]
    frames = [spark.createDataFrame([tuple(r.values()) for r in s], f"k int, {list(s[0])[1]} int").repartition(3)
              for s in sides]
    joined = joins.left_join_chain(
        frames[0], [(frames[1], ["b"]), (frames[2], ["c"])], ["k"],
        HotKeys(rows_per_part=rows_per_part))
    found = Counter(tuple(sorted(r.asDict().items())) for r in joined.collect())
    assert found == brute_left_join(sides, ["k"])


def test_hot_key_is_really_split(spark):
    left = spark.range(9000).selectExpr("CAST(IF(id % 3 = 0, 0, id) AS int) AS k", "id AS a").repartition(4)
    right = spark.range(9000).selectExpr("CAST(IF(id % 3 = 0, 0, id) AS int) AS k", "7 AS b").repartition(4)
    policy = HotKeys(rows_per_part=500)
    parts = hot_key_parts([left, right], ["k"], policy).collect()
    assert [tuple(r) for r in parts] == [(0, 6, 6)]
    dealt = spread([left, right], ["k"], policy)
    for side in dealt:
        sizes = [r["count"] for r in side.where("k = 0").groupBy(PART).count().collect()]
        assert max(sizes) < 3000 * 6 / 10  # 36 parts of about 500 rows each
    # The equal rows of the right side are spread too, as far as there are input partitions.
    own = dealt[1].where("k = 0").select((F.col(PART) % 6).alias("p")).distinct().count()
    assert own > 1


def test_all_hot_keys_are_split(spark):
    left = spark.range(600).selectExpr("CAST(id % 60 AS int) AS k", "id AS a").repartition(3)
    right = spark.range(600).selectExpr("CAST(id % 50 AS int) AS k", "id AS b").repartition(3)
    policy = HotKeys(rows_per_part=2)
    dealt = spread([left, right], ["k"], policy)[0]
    parts = dealt.groupBy("k").agg(F.countDistinct(PART).alias("n")).collect()
    assert len(parts) == 60 and all(r.n > 1 for r in parts)
    joined = joins.left_join_chain(left, [(right, ["b"])], ["k"], policy)
    plain = left.join(right, "k", "left")
    assert Counter(joined.select("k", "a", "b").collect()) == Counter(plain.select("k", "a", "b").collect())


def test_hot_member_is_dealt_out_beside_small_facts(spark):
    """Whatever Spark takes the sizes for, and with members that have no whole key in many tasks."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        member = member_rows(spark, *[(1, 1 + i / 1000) for i in range(60)], *[(None, i / 1000) for i in range(40)]).repartition(3)
        regtype = regtype_rows(spark, (1, 5), (2, 5))
        joined = joins.join_regtype(member, regtype, hot_keys=HotKeys(rows_per_part=10))
        assert PART in joined._jdf.queryExecution().optimizedPlan().toString()
        assert joined.count() == 100 and joined.where("appkey = 'k5'").count() == 60
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_left_rows_without_time_stay(spark):
    member = member_rows(spark, (1, 1)).unionByName(
        spark.createDataFrame([(2, "webA", "x")], "uid int, dn string, register string").withColumn(
            "ts", fn.epoch_ms_to_timestamp(F.col("register"))))
    joined = joins.join_regtype(member, regtype_rows(spark, (1, 5), (2, 5)))
    assert values(joined, "uid", "appkey", "win") == [(1, "k5", joined.where("uid = 1").first().win), (2, None, None)]


@pytest.mark.parametrize("rows_per_call", [None, 14, 1000])
def test_cogroup_over_a_hot_key(spark, rows_per_call):
    left = spark.range(40).selectExpr("CAST(IF(id = 7, NULL, id % 5 % 3) AS int) AS k", "id AS a").repartition(3)
    right = spark.range(30).selectExpr("CAST(IF(id % 3 = 1, 9, id % 3 % 2) AS int) AS k", "id AS b").repartition(3)

    def pairs(l, r):
        return l.merge(r, on="k", how="left")[["k", "a", "b"]].astype("Int64")

    found = joins.cogroup(left, right, ["k"], pairs, "k int, a long, b long", HotKeys(rows_per_part=4), rows_per_call)
    assert Counter(found.collect()) == Counter(left.join(right, "k", "left").select("k", "a", "b").collect())


def test_shuffles_of_the_chain(spark):
    """Three inputs, three shuffles, when nothing is broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sides = [spark.range(100).selectExpr("CAST(id AS int) AS k", f"id AS {c}") for c in "abc"]
        chain = joins.left_join_chain(sides[0], [(sides[1], ["b"]), (sides[2], ["c"])], ["k"], hot_keys=None)
        plan = chain._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- lookups ----------------------------------------------------------------------------------------------------

def test_missed_lookups_keep_the_row(spark):
    rows = spark.createDataFrame(
        [(1, "webA", 1, 1, 1), (2, "webB", 9, 9, 9), (3, "webA", None, None, None)],
        "uid int, dn string, ad_id int, siteid int, vip_id int")
    ads = spark.createDataFrame([(1, "ad", "webA")], "adid int, adname string, dn string")
    sites = spark.createDataFrame(
        [(1, "s", "u", "0", "2000-01-01", "c", "webA")],
        "siteid int, sitename string, siteurl string, delete string, createtime string, creator string, dn string")
    vips = spark.createDataFrame(
        [(1, "v", "s", "e", "l", "x", "n", "next", "op", "webA")],
        "vip_id int, vip_level string, start_time string, end_time string, last_modify_time string, max_free string, "
        "min_free string, next_level string, operator string, dn string")
    found = lookup.lookup_all(rows, ads, sites, vips)
    assert values(found, "uid", "adname", "sitename", "vip_level", "vip_start_time", "ad_hit", "site_hit", "vip_hit") == [
        (1, "ad", "s", "v", "s", True, True, True), (2, None, None, None, None, False, False, False),
        (3, None, None, None, None, False, False, False)]
    assert values(lookup.dead_letters(found), "uid", "missed") == [(2, "ad,site,vip"), (3, "ad")]


def test_failed_request_marks_its_rows(spark):
    from pyspark.sql.types import StringType, StructField, StructType

    def fetch(client, keys):
        raise TimeoutError("too slow")

    big = 9_007_199_254_740_993
    rows = spark.createDataFrame([(1, big), (2, None), (None, big)], "uid int, big long")
    added = StructType([StructField("name", StringType())])
    found = lookup.lookup_by_client(rows, dict, fetch, ["uid"], added)
    assert values(found, "uid", "big", "name", "lookup_error") == [
        (1, big, None, "TimeoutError: too slow"), (2, None, None, "TimeoutError: too slow"), (None, big, None, None)]

    def slow(client, keys):
        import time

        time.sleep(3)
        return {key: {"name": "late"} for key in keys}

    found = lookup.lookup_by_client(rows.where("uid = 1"), dict, slow, ["uid"], added, seconds=0.2)
    assert values(found, "uid", "name", "lookup_error") == [(1, None, "TimeoutError: ")]
    answers = lookup.lookup_by_client(rows, dict, lambda _, keys: {k: {"name": repr(k)} for k in keys}, ["uid"], added)
    assert values(answers, "uid", "name") == sorted([(1, "(1,)"), (2, "(2,)"), (None, None)], key=repr)


# --- last write wins --------------------------------------------------------------------------------------------

def test_latest_row_and_latest_values(spark):
    df = spark.createDataFrame([(1, 1, "a", "x"), (1, 2, None, "y"), (1, 3, "c", None)], "k int, t int, p string, q string")
    assert values(latest.latest_rows(df, ["k"], ["t"]), "k", "t", "p", "q") == [(1, 3, "c", None)]
    assert values(latest.latest_values(df, ["k"], ["t"]), "k", "t", "p", "q") == [(1, 3, "c", "y")]


def test_upserts_and_replay(spark):
    schema = spark.range(0).selectExpr("CAST(id AS int) AS k", "CAST(id AS string) AS v").schema
    table = UpsertTable(spark, fresh_dir(spark, "t"), schema, ["k"])
    assert table.read().count() == 0

    def batch(*rows):
        return spark.createDataFrame(list(rows), "k int, v string, seq int")

    table.upsert(batch((1, "a", 1), (1, "b", 2), (2, "x", 1)), 0, ["seq"])
    assert values(table.read(), "k", "v") == [(1, "b"), (2, "x")]
    for _ in range(2):
        table.upsert(batch((1, "c", 0)), 1, ["seq"])
        assert values(table.read(), "k", "v") == [(1, "c"), (2, "x")]
    table.upsert(batch((1, "b", 2), (2, "x", 1)), 0, ["seq"])  # an older batch again
    assert values(table.read(), "k", "v") == [(1, "c"), (2, "x")]
    assert not table.compact(every=3)
    assert table.compact()
    assert values(table.read(), "k", "v") == [(1, "c"), (2, "x")]
    table.upsert(batch((1, "c", 0)), 1, ["seq"])  # a replay after the fold
    table.upsert(batch((3, "n", 0)), 2, ["seq"])
    assert values(table.read(), "k", "v") == [(1, "c"), (2, "x"), (3, "n")]
    assert table.drop_folded() == 0  # readers from before the fold may still need what it folded
    assert table.compact() and table.drop_folded() == 1
    assert values(table.read(), "k", "v") == [(1, "c"), (2, "x"), (3, "n")]
    with pytest.raises(ValueError, match="new checkpoint"):
        table.upsert(batch((1, "z", 0)), 0, ["seq"])


def test_cells_do_not_depend_on_the_batches(spark):
    rng = random.Random(3)
    records = [(rng.randrange(4), t, rng.choice([None, f"p{t}"]), rng.choice([None, t])) for t in range(40)]
    expected = {}
    for k, _, p, q in records:  # in time order: a later value that is there wins
        old = expected.get(k, (None, None))
        expected[k] = (p if p is not None else old[0], q if q is not None else old[1])
    schema = spark.range(0).selectExpr("CAST(id AS int) AS k", "CAST(id AS string) AS p", "CAST(id AS int) AS q").schema
    for attempt in range(2):
        rng.shuffle(records)
        table = CellTable(spark, fresh_dir(spark, "cells"), schema, ["k"])
        for number in range(4):
            part = records[number * 10:number * 10 + 10]
            table.upsert(spark.createDataFrame(part, "k int, t bigint, p string, q int").withColumn("tie", F.lit(0)), number, ("t", "tie"))
            if attempt and number == 1:
                assert table.compact()
        assert values(table.read(), "k", "p", "q") == sorted(((k, *v) for k, v in expected.items()), key=repr)


def test_records_of_one_time_are_not_mixed(spark):
    schema = spark.range(0).selectExpr("CAST(id AS int) AS k", "CAST(id AS string) AS p", "CAST(id AS string) AS q").schema
    records = [(1, 5, 10, "a", "z"), (1, 5, 20, "b", "y")]
    for order in (records, records[::-1]):
        table = CellTable(spark, fresh_dir(spark, "cells"), schema, ["k"])
        for number, record in enumerate(order):
            table.upsert(spark.createDataFrame([record], "k int, t bigint, tie bigint, p string, q string"), number, ("t", "tie"))
        assert values(table.read(), "p", "q") == [("b", "y")]


def test_fold_between_listing_and_reading(spark):
    """The list is made once for a read, so a fold in between gives neither doubled nor lost rows."""
    schema = spark.range(0).selectExpr("CAST(id AS int) AS k", "CAST(id AS string) AS v").schema
    rows = UpsertTable(spark, fresh_dir(spark, "t"), schema, ["k"])
    cells = CellTable(spark, fresh_dir(spark, "c"), schema, ["k"])
    for number, value in enumerate("ab"):
        batch = spark.createDataFrame([(1, value, number)], "k int, v string, t bigint")
        rows.upsert(batch, number, ["t"])
        cells.upsert(batch, number, ("t", "t"))
    for table in (rows, cells):
        listed = table._folders._finished

        def fold_after(table=table, listed=listed):
            found = listed()
            table._folders._finished = listed
            table.compact()
            table.drop_folded()
            return found

        table._folders._finished = fold_after
        assert values(table.read(), "k", "v") == [(1, "b")]
        assert values(table.read(), "k", "v") == [(1, "b")]


def test_unfinished_batches_are_not_read(spark):
    schema = spark.range(0).selectExpr("CAST(id AS int) AS k", "CAST(id AS string) AS v").schema
    path = fresh_dir(spark, "t")
    table = UpsertTable(spark, path, schema, ["k"])
    table.upsert(spark.createDataFrame([(1, "a", 1)], "k int, v string, seq int"), 0, ["seq"])
    spark.createDataFrame([(1, "half")], "k int, v string").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/kind=delta/batch_id=1")
    assert values(table.read(), "k", "v") == [(1, "a")]


# --- ordered ----------------------------------------------------------------------------------------------------

def timeline(spark, seed=1):
    rng = random.Random(seed)
    times = [rng.randrange(0, 4_000) * 1_000_000 for _ in range(300)]
    data = [(i, rng.choice(["hot", "hot", "a", None]), t) for i, t in enumerate(times)] + [(300, "a", None)]
    return data, spark.createDataFrame(data, "id int, k string, us bigint").selectExpr(
        "id", "k", "timestamp_micros(us) AS ts").repartition(3)


@pytest.mark.parametrize("slice_size", ["1 minute", "1 day"])
def test_running_count_by_brute_force(spark, slice_size):
    data, df = timeline(spark)
    order = {i: (t is not None, t or 0, i) for i, _, t in data}
    expected = {i: sum(1 for j, k2, _ in data if k2 == k and order[j] <= order[i]) for i, k, _ in data}
    found = ordered.running_count(df, ["k"], "ts", ["id"], slice_size=slice_size)
    assert {r.id: r.n for r in found.collect()} == expected


@pytest.mark.parametrize("rows_per_part", [7, 1_000])
def test_running_count_in_ranges_by_brute_force(spark, rows_per_part):
    data, df = timeline(spark)
    # Half of the rows have no time, and many share one.
    data = [(i, k, None if i % 2 else t and t // 500_000_000 * 500_000_000) for i, k, t in data]
    df = spark.createDataFrame(data, "id int, k string, us bigint").selectExpr("id", "k", "timestamp_micros(us) AS ts", "id AS `a-b`")
    order = {i: (t is not None, t or 0, i) for i, _, t in data}
    expected = {i: sum(1 for j, k2, _ in data if k2 == k and order[j] <= order[i]) for i, k, _ in data}
    found = ordered.running_count_in_ranges(df, ["k"], "ts", ["id"], rows_per_part=rows_per_part)
    assert found.columns == ["id", "k", "ts", "a-b", "n"]
    assert {r.id: r.n for r in found.collect()} == expected
    assert ordered.running_count_in_ranges(df.limit(0), ["k"], "ts", ["id"]).count() == 0


def test_one_key_is_many_even_ranges(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("id", "'hot' AS k", "IF(id % 2 = 0, NULL, timestamp_seconds(5)) AS ts")
    path = str(tmp_path / "ranges")
    found = ordered.running_count_in_ranges(rows, ["k"], "ts", ["id"], rows_per_part=1_000, path=path)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.shiftright("_at", 33)).count().collect()]
    assert len(sizes) >= 18 and max(sizes) <= 2_000
    assert found.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()[:] == (1, 20_000, 20_000)
    assert found.where("n <= 10000 AND ts IS NOT NULL").isEmpty()


@pytest.mark.parametrize("slice_size", ["1 minute", "1 day"])
def test_previous_time_by_brute_force(spark, slice_size):
    data, df = timeline(spark)
    expected = {}
    for i, k, t in data:
        before = [(t2, j) for j, k2, t2 in data if k2 == k and t2 is not None and t is not None and (t2, j) < (t, i)]
        last = max(before)[0] if before else None
        expected[i] = last if last is not None and t - last <= 60_000_000 else None
    found = ordered.previous_time(df, ["k"], "ts", ["id"], ttl="1 minute", slice_size=slice_size)
    assert {r.id: r.previous_us for r in found.collect()} == expected


@pytest.mark.parametrize("slice_size", ["10 seconds", "5 minutes", "1 day"])
def test_sessions_by_brute_force(spark, slice_size):
    data, df = timeline(spark, seed=2)
    expected = []
    for key in {k for _, k, _ in data}:
        times = sorted(t for _, k, t in data if k == key and t is not None)
        run = [times[0]]
        for t in times[1:]:
            if t - run[-1] <= 20_000_000:
                run.append(t)
            else:
                expected.append((key, run[0], run[-1] + 20_000_000, len(run)))
                run = [t]
        expected.append((key, run[0], run[-1] + 20_000_000, len(run)))
    found = ordered.sessions(df, ["k"], "ts", gap="20 seconds", slice_size=slice_size)
    assert values(found, "k", "start_us", "end_us", "n") == sorted(expected, key=repr)


@pytest.mark.parametrize("slice_size", ["10 seconds", "1 day"])
def test_sessions_are_those_of_session_window(spark, slice_size):
    """Times with many gaps of exactly twenty seconds, on both sides of a slice's border."""
    df = spark.range(400).selectExpr("id % 3 AS k", "timestamp_seconds(id * id % 977 * 10) AS ts")
    found = ordered.sessions(df, ["k"], "ts", gap="20 seconds", slice_size=slice_size)
    theirs = windows.flat_window(windows.session_counts(df, ["k"], "ts", "20 seconds"))
    assert values(found, "k", "start_us", "end_us", "n") == values(theirs, "k", "start_us", "end_us", "n")


# --- words ------------------------------------------------------------------------------------------------------

def test_words_on_space(spark):
    lines = spark.createDataFrame([("a  b ",), ("   ",), ("",), (" c",), ("d\te",)], "line string")
    assert sorted(r.word for r in words.words_on_space(lines).collect()) == sorted(["a", "", "b", "", "", "c", "d\te"])
    assert sorted(r.word for r in words.non_empty(words.words_on_whitespace(lines)).collect()) == list("abcde")


def test_poison_stops_the_job(spark):
    lines = spark.createDataFrame([("a bug",)], "line string")
    with pytest.raises(Exception, match="bug....."):
        words.count_words(words.fail_on(words.words_on_space(lines))).collect()


# --- projections ------------------------------------------------------------------------------------------------

def test_wide_row_masks(spark):
    base = spark.range(1).selectExpr(*[
        f"CAST(1 AS {f.dataType.simpleString()}) AS `{f.name}`" if f.name in ("uid", "ad_id", "siteid", "vip_id")
        else f"'ab-9' AS `{f.name}`" for f in WIDE_MEMBER])
    row = projection.wide_row(base, mask=projection.SENSITIVE_COLUMNS).first()
    assert row.email == "xx-n" and row.fullname == "ab-9" and len(row) == 41
    with pytest.raises(ValueError):
        projection.wide_row(base, mask=["nothing"])


def test_blank_fill_and_json(spark):
    df = spark.createDataFrame([(None, 1)], "a string, b int")
    filled = projection.blank_fill(df, ["a", "b"])
    assert tuple(filled.first()) == ("", "1")
    assert projection.as_json(filled).first().value == '{"a":"","b":"1"}'


# --- sources and sinks without a server -------------------------------------------------------------------------

def test_sql_parameters():
    sql = render_sql("SELECT * FROM t WHERE a = ? AND b = '?' AND c IN (?, ?) AND d = ?",
                     ["it's ?", 3, None, Decimal("1.50")])
    assert sql == "SELECT * FROM t WHERE a = 'it''s ?' AND b = '?' AND c IN (3, NULL) AND d = 1.50"
    with pytest.raises(ValueError):
        render_sql("?", [])
    with pytest.raises(ValueError):
        render_sql("1", [1])
    for value in (object(), float("nan"), __import__("datetime").datetime.now(__import__("datetime").timezone.utc)):
        with pytest.raises(TypeError):
            render_sql("?", [value])
    assert render_sql("5-?", [-3]) == "5-(-3)"
    with pytest.raises(ValueError):
        render_sql("SELECT 1 -- ?", [1])


class FakeReader:
    def __init__(self):
        self.seen = {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def option(self, name, value):
        self.seen[name] = value
        return self

    def options(self, **more):
        self.seen |= more
        return self

    def load(self):
        return self.seen


class FakeSession:
    def __init__(self):
        self.read = self.readStream = FakeReader()


def test_jdbc_options():
    whole = jdbc_query(FakeSession(), "jdbc:x", "SELECT 1 WHERE 1 = ?", [1], user="u")
    assert whole["query"] == "SELECT 1 WHERE 1 = 1" and whole["user"] == "u" and "dbtable" not in whole
    split = jdbc_query(FakeSession(), "jdbc:x", "SELECT * FROM t", split_on="id", bounds=(0, 99), splits=4)
    assert split["dbtable"] == "(SELECT * FROM t) q" and split["numPartitions"] == 4 and "query" not in split


def test_kafka_options_start_with_the_oldest():
    options = kafka_options("h:1", ["a", "b"], 10)
    assert options["subscribe"] == "a,b" and options["startingOffsets"] == "earliest"
    assert options["maxOffsetsPerTrigger"] == "10"
    with pytest.raises(ValueError):
        read_raw_log(FakeSession(), ["a"])


def test_topic_filter_prunes_folders(spark):
    path = fresh_dir(spark, "log")
    spark.createDataFrame([("a", "1"), ("b", "2")], "topic string, value string").write.partitionBy("topic").parquet(path)
    log = read_raw_log(spark, ["b"], path=path, stream=False)
    assert [tuple(r) for r in log.collect()] == [("b", "2")]
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert "(topic#" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_client_writer_sends_in_groups():
    sent = []

    class Client:
        closed = False

        def close(self):
            Client.closed = True

    class Row(dict):
        def asDict(self, recursive):
            return dict(self)

    writer = ClientWriter(Client, lambda client, rows: sent.append(len(rows)), size=2)
    assert writer.open(0, 0)
    for n in range(5):
        writer.process(Row(n=n))
    writer.close(None)
    assert sent == [2, 2, 1] and Client.closed


def test_shared_folder_is_the_one_named(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")


def test_payment_layout():
    assert [f.name for f in PAYMENT if f.dataType.typeName() == "integer"] == ["uid", "siteid", "vip_id"]


@pytest.mark.parametrize("joined, most", [("one", 3), ("two", 6), ("chain", 3)])
def test_joins_read_the_keys_once_where_none_is_hot(spark, joined, most):
    """Planning a join takes the jobs of one small aggregation for each join, and none that runs a join."""
    from rollcall.operators.joins import join_member_facts, join_payment, join_regtype
    from suite import views

    facts = views.facts(spark, "/root/testdata/sf0.001")
    tracker, group = spark.sparkContext.statusTracker(), f"planning-{joined}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        if joined == "one":
            join_regtype(*facts[:2])
        elif joined == "two":
            join_payment(join_regtype(*facts[:2]), facts[2], counted=facts[0])
        else:
            join_member_facts(*facts)
        assert 1 <= len(tracker.getJobIdsForGroup(group)) <= most
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_frames_of_row_functions_are_bounded():
    """Frames of words don't grow with the batch or with a text."""
    texts = ["a b\tc\x0b\xa0d " * 300, None, "", "  ", "x" * 500, "y z" + " w" * 5_000]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, None, 5, 2 ** 60 + 1]), pa.array(texts)], names=["doc_id", "line"])
    frames = list(word_pairs(most=100, most_chars=400)(iter([batch, batch])))
    assert max(f.num_rows for f in frames) <= 100 and max(sum(map(len, f.column("word").to_pylist())) for f in frames) < 900
    found = Counter((r["doc_id"], r["word"], r["n"]) for f in frames for r in f.to_pylist())
    assert found == Counter(2 * [(1, w, 1) for _ in range(300) for w in ("a", "b", "c", "\xa0d")]
                            + 2 * [(5, "x" * 500, 1), (2 ** 60 + 1, "y", 1), (2 ** 60 + 1, "z", 1)] + 10_000 * [(2 ** 60 + 1, "w", 1)])
