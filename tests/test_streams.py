"""Streams over several micro-batches against the batch result, restarts, late rows, state that expires."""

from __future__ import annotations

import json
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rollcall.operators.joins import SMALL_WINDOW, in_window, join_member_facts, join_regtype
from rollcall.operators.skew import HotKeys
from rollcall.plans import ods
from rollcall.plans.member_wide import current_members, wide_rows, wide_table
from rollcall.schemas import MEMBER, PAYMENT, REGTYPE
from rollcall.session import fresh_dir, use_settings
from rollcall.sinks.console import show_on_console
from rollcall.sinks.row_client import ClientWriter
from rollcall.sinks.topic_log import topic_stream
from rollcall.sinks.upsert_table import UpsertTable
from rollcall.sources import read_lines
from rollcall.streaming import jobs
from rollcall.streaming.arrival import arrival_sessions
from rollcall.streaming.early import early_changes, early_left_join, early_table, standing, start_early_table
from rollcall.streaming.event_time import fact_time, member_time
from rollcall.streaming.grouped import cogroup_stream
from rollcall.streaming.running import RunningCount
from rollcall.streaming.ttl_state import last_logins

MINUTE = 60_000
START = 1_704_067_200_000


def write_lines(folder: str, name: str, *lines: str) -> None:
    Path(folder).mkdir(parents=True, exist_ok=True)
    Path(folder, name).write_text("".join(f"{line}\n" for line in lines))


def record(schema, **fields):
    return tuple(fields.get(f.name) for f in schema)


class Feed:
    """A folder that gets one file per step, and the stream that reads it."""

    def __init__(self, spark, schema):
        self.spark, self.schema = spark, schema
        self.folder = fresh_dir(spark, "feed")
        self.all = []
        self.add([])

    def add(self, rows):
        self.all += rows
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.folder)

    def stream(self):
        return self.spark.readStream.schema(self.schema).parquet(self.folder)

    def batch(self):
        return self.spark.createDataFrame(self.all, self.schema)


def member(uid, minute, **more):
    return record(MEMBER, uid=uid, dn="webA", ad_id=uid % 3, register=str(int(minute * MINUTE)), **more)


def regtype(uid, minute):
    return record(REGTYPE, uid=uid, dn="webA", appkey=f"k{minute}", createtime=str(int(minute * MINUTE)))


def payment(uid, minute, siteid=1, vip_id=1):
    return record(PAYMENT, uid=uid, dn="webA", paymoney=f"{minute}.00", siteid=siteid, vip_id=vip_id,
                  createtime=str(int(minute * MINUTE)))


STEPS = [  # members, registration types, payments of one micro-batch each
    ([(1, 1), (2, 3)], [(1, 5)], [(2, 4)]),
    ([(1, 2), (3, 12)], [(1, 6), (3, 5)], [(1, 7), (3, 13)]),
    ([(4, 25), (1, 31)], [(4, 26), (9, 26)], [(9, 27)]),
    ([(2, 45)], [], [(1, 32)]),
]
CLOSING = ([(-1, 900)], [(-1, 900)], [(-1, 900)])


def dimension_tables(spark):
    tables = ods.dimension_tables(spark, fresh_dir(spark, "dims"))
    log = spark.createDataFrame([
        ("basead", '{"adid":"1","adname":"one","dn":"webA"}', 1, 0),
        ("basead", '{"adid":"2","adname":"old","dn":"webA"}', 1, 1),
        ("basead", '{"adid":"2","adname":"two","dn":"webA"}', 2, 0),
        ("basewebsite", '{"siteid":"1","sitename":"s","siteurl":"u","createtime":"c","dn":"webA"}', 1, 0),
        ("membervip", '{"vip_id":"1","vip_level":"v","start_time":"2020","dn":"webA"}', 1, 0),
        ("membervip", "broken", 1, 0),
    ], "topic string, value string, arrived bigint, offset bigint")
    ods.upsert_dimensions(log, 0, tables)
    return tables


def timed(feeds):
    return member_time(feeds[0].stream()), fact_time(feeds[1].stream()), fact_time(feeds[2].stream())


def batch_facts(feeds):
    return member_time(feeds[0].batch()), fact_time(feeds[1].batch()), fact_time(feeds[2].batch())


@pytest.mark.parametrize("start", [jobs.start_member_stream, jobs.start_collapsed_member_stream])
def test_wide_table_of_the_stream_is_that_of_the_batch(spark, start):
    """Each step is a run of its own on the same checkpoint, so this is a restart test as well."""
    feeds = [Feed(spark, s) for s in (MEMBER, REGTYPE, PAYMENT)]
    tables, wide, checkpoint = dimension_tables(spark), wide_table(spark, fresh_dir(spark, "wide")), fresh_dir(spark, "cp")
    for step in [*STEPS, CLOSING]:
        for feed, make, rows in zip(feeds, (member, regtype, payment), step):
            feed.add([make(*r) for r in rows])
        start(*timed(feeds), tables, wide, checkpoint).awaitTermination()
    dims = [tables[t].read() for t in ("dwd_basead", "dwd_basewebsite", "dwd_membervip")]
    expected = current_members(*batch_facts(feeds), *dims).where("uid > 0").collect()
    assert len(expected) == 4
    assert Counter(wide.read().where("uid > 0").collect()) == Counter(expected)


def test_found_before_missed_in_one_window(spark):
    """Of several ids in a window the last one that a dimension knows counts, also where a later one is unknown or NULL."""
    feeds = [Feed(spark, s) for s in (MEMBER, REGTYPE, PAYMENT)]
    tables, wide, checkpoint, dead = (dimension_tables(spark), wide_table(spark, fresh_dir(spark, "wide")), fresh_dir(spark, "cp"),
                                      fresh_dir(spark, "dead"))
    def with_ad(uid, minute, ad_id, **more):
        return record(MEMBER, uid=uid, dn="webA", ad_id=ad_id, register=str(int(minute * MINUTE)), **more)

    feeds[0].add([with_ad(1, 1, 1, fullname="a"), with_ad(1, 2, 2), with_ad(1, 3, 99, qq="q"), with_ad(1, 4, None), with_ad(2, 1, 98)])
    feeds[2].add([payment(1, 1, 1, 9), payment(1, 2, 8, 1), payment(1, 3, None, 7), payment(1, 4, 6, None), payment(3, 1)])
    feeds[1].add([regtype(1, 2)])
    jobs.start_collapsed_member_stream(*timed(feeds), tables, wide, checkpoint, dead_letter_path=dead).awaitTermination()
    for feed, make in zip(feeds, (member, regtype, payment)):
        feed.add([make(-1, 900)])
    jobs.start_collapsed_member_stream(*timed(feeds), tables, wide, checkpoint, dead_letter_path=dead).awaitTermination()
    dims = [tables[t].read() for t in ("dwd_basead", "dwd_basewebsite", "dwd_membervip")]
    expected = current_members(*batch_facts(feeds), *dims).where("uid > 0").collect()
    found = wide.read().where("uid > 0").collect()
    assert Counter(found) == Counter(expected)
    assert {(r.uid, r.ad_id, r.adname, r.siteid, r.sitename, r.vip_level) for r in found} == {
        (1, 99, "two", 6, "s", "v"), (2, 98, None, None, None, None)}
    letters = spark.read.parquet(dead).where("uid > 0").collect()
    assert Counter((r.uid, r.ad_id, r.siteid, r.vip_id, r.missed) for r in letters) == Counter([
        (1, 99, 6, 7, "ad,site,vip"), (1, 99, None, None, "ad"), (1, None, 8, 1, "site"), (1, None, 1, 9, "vip"),
        (1, None, None, 7, "vip"), (1, None, 6, None, "site"), (2, 98, None, None, "ad")])


def test_dead_letters_and_pairs(spark):
    feeds = [Feed(spark, s) for s in (MEMBER, REGTYPE, PAYMENT)]
    dead = fresh_dir(spark, "dead")
    tables, wide = dimension_tables(spark), wide_table(spark, fresh_dir(spark, "wide"))
    checkpoint = fresh_dir(spark, "cp")
    for step in (([(1, 1), (3, 2)], [(1, 2), (3, 3)], [(1, 3), (3, 3)]), CLOSING):
        for feed, make, rows in zip(feeds, (member, regtype, payment), step):
            feed.add([make(*r) for r in rows])
        jobs.start_member_stream(*timed(feeds), tables, wide, checkpoint, dead_letter_path=dead).awaitTermination()
    letters = spark.read.parquet(dead).where("uid > 0").select("uid", "missed").collect()
    assert [tuple(r) for r in letters] == [(3, "ad")]
    dims = [tables[t].read() for t in ("dwd_basead", "dwd_basewebsite", "dwd_membervip")]
    pairs = wide_rows(*batch_facts(feeds), *dims).where("uid = 1").select("adname", "sitename", "vip_level", "ad_hit")
    assert [tuple(r) for r in pairs.collect()] == [("one", "s", "v", True)]


def run_to_memory(spark, df, name, checkpoint=None, mode="append"):
    writer = df.writeStream.format("memory").queryName(name).outputMode(mode)
    return writer.start()


def test_late_member_gives_nothing_but_with_lateness(spark):
    """A member that comes after the watermark has passed its window is dropped, unless lateness is allowed."""
    for lateness, expected in (("0 seconds", [3]), ("2 hours", [3, 5])):
        left, right = Feed(spark, MEMBER), Feed(spark, REGTYPE)
        joined = join_regtype(
            member_time(left.stream(), lateness=lateness), fact_time(right.stream(), lateness=lateness))
        query = run_to_memory(spark, joined.select("uid", "appkey"), f"late_{len(expected)}")
        for members, regtypes in (([(3, 1)], [(9, 1)]), ([(9, 60)], [(9, 60)]), ([(5, 1)], []),
                                  ([(9, 900)], [(9, 900)])):
            left.add([member(*m) for m in members])
            right.add([regtype(*r) for r in regtypes])
            query.processAllAvailable()
        query.stop()
        found = spark.table(f"late_{len(expected)}").where("uid IN (3, 5)").collect()
        assert sorted(r.uid for r in found) == expected


def test_small_window_join(spark):
    left, right = Feed(spark, MEMBER), Feed(spark, REGTYPE)
    joined = join_regtype(
        member_time(left.stream(), lateness="2 minutes"), fact_time(right.stream(), lateness="2 minutes"),
        size=SMALL_WINDOW)
    query = run_to_memory(spark, joined.select("uid", "appkey"), "small")
    for members, regtypes in (([(1, 0.05), (2, 0.05)], [(2, 0.3)]), ([], [(1, 0.1)]), ([(-1, 900)], [(-1, 900)])):
        left.add([member(*m) for m in members])
        right.add([regtype(*r) for r in regtypes])
        query.processAllAvailable()
    query.stop()
    found = {(r.uid, r.appkey) for r in spark.table("small").where("uid > 0").collect()}
    assert found == {(1, "k0.1"), (2, None)}


def test_early_results_settle_to_the_left_join(spark):
    left, right = Feed(spark, MEMBER), Feed(spark, REGTYPE)
    early = early_left_join(member_time(left.stream()), fact_time(right.stream()))
    query = run_to_memory(spark, early.select("uid", "register", "win_us", "appkey", "provisional"), "early")
    seen = []
    for members, regtypes, _ in STEPS:
        left.add([member(*m) for m in members])
        right.add([regtype(*r) for r in regtypes])
        query.processAllAvailable()
        seen.append(spark.table("early").count())
    query.stop()
    assert seen[0] == 3  # two members at once, and the pair that is there already
    rows = spark.table("early").collect()
    matched = {(r.uid, r.win_us) for r in rows if not r.provisional}
    settled = Counter((r.uid, r.register, r.appkey) for r in rows
                      if not r.provisional or (r.uid, r.win_us) not in matched)
    batch = join_regtype(member_time(left.batch()), fact_time(right.batch()))
    assert settled == Counter((r.uid, r.register, r.appkey) for r in batch.collect())


@pytest.mark.parametrize("hot_keys", [HotKeys(), None])
def test_early_table_stands_as_the_left_join_after_each_step(spark, hot_keys):
    """A restart before every step; a row without a match is withdrawn by the table itself."""
    left, right = Feed(spark, MEMBER), Feed(spark, REGTYPE)
    changes = early_changes(member_time(left.stream(), lateness="1 day"), fact_time(right.stream(), lateness="1 day"), hot_keys=hot_keys)
    table, checkpoint = early_table(spark, fresh_dir(spark, "early"), changes.schema), fresh_dir(spark, "cp")
    for members, regtypes, _ in STEPS:
        left.add([member(*m) for m in members])
        right.add([regtype(*r) for r in regtypes])
        start_early_table(changes, table, checkpoint, compact_after=2).awaitTermination()
        batch = join_regtype(member_time(left.batch()), fact_time(right.batch())).where("member_us IS NOT NULL")
        expected = Counter((r.uid, r.register, r.appkey) for r in batch.collect())
        assert Counter((r.uid, r.register, r.appkey) for r in standing(table).collect()) == expected


def test_right_rows_meet_the_notices_in_one_join(spark):
    """The notices stand in state once for every lane, so the join with them is not run a second time for the withdrawals."""
    left, right = Feed(spark, MEMBER), Feed(spark, REGTYPE)
    changes = early_changes(member_time(left.stream()), fact_time(right.stream()))
    assert changes._jdf.queryExecution().analyzed().toString().count("Generate explode(sequence") == 1


def test_state_follows_the_cores_and_settings_come_back(spark):
    """A stream of many shuffle partitions keeps few stores, and early results need no batch without rows."""
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        left, right, pay = Feed(spark, MEMBER), Feed(spark, REGTYPE), Feed(spark, PAYMENT)
        left.add([member(1, 1)])
        right.add([regtype(1, 1)])
        changes = early_changes(member_time(left.stream()), fact_time(right.stream()))
        checkpoint = fresh_dir(spark, "cp")
        start_early_table(changes, early_table(spark, fresh_dir(spark, "early"), changes.schema), checkpoint).awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
        assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"
        stores = spark.read.format("state-metadata").load(checkpoint)
        assert {r.numPartitions for r in stores.collect()} == {max(12, spark.sparkContext.defaultParallelism)}
        assert len({p.name for p in Path(checkpoint, "offsets").glob("[0-9]*")}) == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)


def test_options_of_the_state_store_reach_a_session_of_somebody_else(spark):
    option = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
    other = spark.newSession()
    other.conf.set(option, "false")
    assert use_settings(other).conf.get(option) == "true"


def test_identical_records_are_one_result_unless_told_apart(spark):
    at = str(START)
    both = [record(MEMBER, uid=1, dn="webA", register=at)] * 2
    left = spark.createDataFrame(both, MEMBER).selectExpr("*", "monotonically_increasing_id() AS number")
    right = spark.createDataFrame([record(REGTYPE, uid=1, dn="webA", createtime=at)], REGTYPE).selectExpr("*", "7L AS number")
    folders = [fresh_dir(spark, "feed") for _ in range(2)]
    for side, folder in zip((left, right), folders):
        side.write.parquet(folder)
    for number, results in ((None, 1), ("number", 2)):
        member, regtype = (spark.readStream.schema(side.schema).parquet(folder) for side, folder in zip((left, right), folders))
        changes = early_changes(member_time(member), fact_time(regtype), record=number)
        table = early_table(spark, fresh_dir(spark, "early"), changes.schema)
        start_early_table(changes, table, fresh_dir(spark, "cp")).awaitTermination()
        assert standing(table).count() == results and standing(table).where("regtype_us IS NULL").isEmpty()


def test_sessions_are_merged_before_the_shuffle_and_survive_a_restart(spark):
    shape = "k string, arrived long"
    folder, out, checkpoint = (fresh_dir(spark, label) for label in ("feed", "landed", "cp"))
    seconds = 1_000_000
    # The second step goes on with the open session of the first one, once exactly a gap later; the last one closes all.
    for step in ([("a", t * seconds) for t in range(4)] + [(None, 0), ("b", None)], [("a", 7 * seconds), ("a", 12 * seconds), ("a", 18 * seconds)], [("z", 10**15)]):
        spark.createDataFrame(step, shape).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(shape).parquet(folder)
        found = arrival_sessions(stream, ["k"], "5 seconds", out_of_order="1 minute")
        query = (found.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        plan = query._jsq.explainInternal(False)
    assert plan.count("MergingSessions") >= 2
    assert plan.rindex("MergingSessions") > plan.rindex("Exchange hashpartitioning")
    rows = spark.read.schema(found.schema).parquet(out).select("k", F.unix_micros("win.start"), F.unix_micros("win.end"), "n").collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [("a", 0, 17 * seconds, 6), ("a", 18 * seconds, 23 * seconds, 1), (None, 0, 5 * seconds, 1)], key=str)


def test_poison_then_restart(spark):
    folder, checkpoint, topic = fresh_dir(spark, "lines"), fresh_dir(spark, "cp"), fresh_dir(spark, "topic")
    counts = UpsertTable(spark, fresh_dir(spark, "counts"), jobs.WORD_COUNTS, ["word"])

    def run():
        jobs.start_word_count(
            read_lines(spark, folder, max_files=1), counts, checkpoint, topic="word_counts", topic_path=topic,
        ).awaitTermination()

    def now():
        return {r.word: r.n for r in counts.read().collect()}

    write_lines(folder, "1.txt", "a b", "a")
    run()
    assert now() == {"a": 2, "b": 1}
    write_lines(folder, "2.txt", "a bug")
    with pytest.raises(Exception, match="bug....."):
        run()
    assert now() == {"a": 2, "b": 1}
    write_lines(folder, "2.txt", "a c")
    run()
    assert now() == {"a": 3, "b": 1, "c": 1}
    sent = [r.value for r in spark.read.parquet(topic).collect()]
    assert Counter(sent) == Counter(["a::2", "b::1", "a::3", "c::1"])


def test_last_login_expires(spark):
    feed = Feed(spark, spark.range(0).selectExpr("id AS user", "id AS ms").schema)
    logins = feed.stream().selectExpr("user", f"timestamp_millis(ms + {START}) AS ts")
    query = run_to_memory(spark, last_logins(logins, ["user"]), "logins")
    for step in ([(1, 0), (1, 5 * MINUTE), (2, 0)], [(1, 60 * MINUTE)], [(1, 200 * MINUTE), (2, 201 * MINUTE)],
                 [(1, 230 * MINUTE)]):
        feed.add(step)
        query.processAllAvailable()
    query.stop()
    us = MINUTE * 1000
    shift = START * 1000
    found = Counter(
        (r.user, r.us - shift, r.previous_us and r.previous_us - shift) for r in spark.table("logins").collect())
    assert found == Counter([
        (1, 0, None), (1, 5 * us, 0), (2, 0, None), (1, 60 * us, 5 * us), (1, 200 * us, None), (2, 201 * us, None),
        (1, 230 * us, 200 * us)])


def test_records_without_time_are_kept_apart(spark):
    feeds = [Feed(spark, s) for s in (MEMBER, REGTYPE)]
    feeds[0].add([member(1, 1), record(MEMBER, uid=2, dn="webA", register="soon")])
    feeds[1].add([record(REGTYPE, uid=3, dn="webA"), regtype(4, 2)])
    out = fresh_dir(spark, "untimed")
    streams = {"member": member_time(feeds[0].stream()), "regtype": fact_time(feeds[1].stream())}
    jobs.start_untimed_stream(streams, out, fresh_dir(spark, "cp")).awaitTermination()
    found = {(r.side, json.loads(r.value)["uid"]) for r in spark.read.parquet(out).collect()}
    assert found == {("member", 2), ("regtype", 3)}


def test_fact_stream_writes_each_record_once(spark):
    """The file sink keeps a log of its own, so a second run adds only what is new."""
    feed = Feed(spark, spark.createDataFrame([], "topic string, value string").schema)
    out, checkpoint = fresh_dir(spark, "second"), fresh_dir(spark, "cp")
    for step in ([("member", '{"uid":"1"}'), ("member", "junk"), ("basead", "{}")], [("other", "{}")]):
        feed.add(step)
        jobs.start_fact_stream(feed.stream(), checkpoint, path=out).awaitTermination()
    found = sorted((r.topic, r.value) for r in spark.read.parquet(out).collect())
    assert found == [("dwdmember", '{"uid":"1"}'), ("dwdother", "{}")]
    with pytest.raises(ValueError):
        topic_stream(feed.stream(), checkpoint)


def test_fan_out_replaces_a_replayed_batch(spark):
    out = fresh_dir(spark, "outputs")
    write = jobs.fan_out({"small": F.col("id") < 3, "large": F.col("id") >= 3}, out)
    for _ in range(2):
        write(spark.range(5), 0)
    write(spark.range(5, 7), 1)
    found = Counter((r.output, r.id) for r in spark.read.parquet(out).collect())
    assert found == Counter([("small", 0), ("small", 1), ("small", 2)] + [("large", i) for i in range(3, 7)])


def test_rows_through_a_client(spark, tmp_path):
    target = str(tmp_path / "client")
    feed = Feed(spark, spark.range(0).schema)
    feed.add([(1,), (2,), (3,)])

    def put(client, rows):
        import uuid
        from pathlib import Path as P
        P(client).mkdir(exist_ok=True)
        P(client, uuid.uuid4().hex).write_text(",".join(str(r["id"]) for r in rows))

    query = feed.stream().writeStream.foreach(ClientWriter(lambda: target, put, size=2)).trigger(availableNow=True).start()
    query.awaitTermination()
    sent = [int(n) for f in Path(target).iterdir() for n in f.read_text().split(",")]
    assert sorted(sent) == [1, 2, 3]


def test_console(spark, capfd):
    feed = Feed(spark, spark.createDataFrame([], "word string").schema)
    feed.add([("hello-console",)])
    query = show_on_console(feed.stream(), 1_000, "wordcount").trigger(availableNow=True).start()
    assert query.name == "wordcount"
    query.awaitTermination()
    assert query.exception() is None


def held_by_partition(spark, checkpoint):
    """Rows in the state of every stateful operator, by partition."""
    found = {}
    for operator in sorted(Path(checkpoint, "state").iterdir(), key=lambda p: int(p.name)):
        reader = spark.read.format("statestore").option("operatorId", operator.name)
        if (operator / "0" / "left-keyToNumValues").exists():
            reader = reader.option("joinSide", "left")
        found[int(operator.name)] = {r.partition_id: r["count"] for r in reader.load(checkpoint).groupBy("partition_id").count().collect()}
    return found


def test_a_frequent_member_is_dealt_out_in_the_stream(spark):
    """One member has a third of the member rows and of the right rows; matches come before and after, in two runs."""
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        left, right, pay = Feed(spark, MEMBER), Feed(spark, REGTYPE), Feed(spark, PAYMENT)
        out, checkpoint = fresh_dir(spark, "out"), fresh_dir(spark, "cp")
        columns = ["uid", "register", "appkey", "paymoney", "member_us", "regtype_us", "payment_us"]
        steps = [
            ([(7, 1 + i / 1000) for i in range(150)] + [(100 + i, 2) for i in range(300)], [(7, 3 + i / 1000) for i in range(15)] + [(100, 1)], []),
            ([(7, 4 + i / 1000) for i in range(150)] + [(500 + i, 5) for i in range(300)],
             [(7, 5), (7, 5), (101, 4), (500, 5)], [(7, 6), (7, 6.5), (101, 5)]),
        ]
        for step in (*steps, CLOSING):
            for feed, make, rows in zip((left, right, pay), (member, regtype, payment), step):
                feed.add([make(*r) for r in rows])
            joined = join_member_facts(member_time(left.stream()), fact_time(right.stream()), fact_time(pay.stream()))
            (joined.select(*columns).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start().awaitTermination())
            if step is steps[1]:
                held = held_by_partition(spark, checkpoint)
        batch = join_member_facts(member_time(left.batch()), fact_time(right.batch()), fact_time(pay.batch()))
        expected = Counter(map(tuple, batch.select(*columns).where("uid > 0").collect()))
        assert Counter(map(tuple, spark.read.parquet(out).where("uid > 0").collect())) == expected
        assert sum(expected.values()) == 300 * 17 * 2 + 600
        # Of 900 member rows 300 are those of one key: no partition of the joins has much more than its share.
        whole = [h for h in held.values() if sum(h.values()) >= 900]
        assert len(whole) >= 2 and all(len(h) == 8 and max(h.values()) < 2 * sum(h.values()) / 8 for h in whole), held
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)


def test_cogroup_of_streams_is_that_of_the_batch(spark):
    """Restarted after each step; a frequent key is called in parts, and keys that only the right side has give nothing."""
    left, right, out, checkpoint = Feed(spark, MEMBER), Feed(spark, REGTYPE), fresh_dir(spark, "out"), fresh_dir(spark, "cp")
    schema = "uid long, register string, before int"

    def earlier(l, r):
        """How many right rows of the key are not later than each left row: nothing a join says."""
        both = l.merge(r, on="uid", how="left")
        both["before"] = both["createtime"].fillna("~").le(both["register"]).astype(int)
        return both.groupby(["uid", "register"], as_index=False)["before"].sum().astype({"before": "int32"})

    def sides(member_rows, regtype_rows):
        l = in_window(member_rows, "ts").select(F.col("uid").cast("long").alias("uid"), "win", "register")
        return l, in_window(regtype_rows, "ts").select(F.col("uid").cast("long").alias("uid"), "win", "createtime")

    steps = [([(7, 1 + i / 100) for i in range(100)] + [(1, 2)], [(7, 1.5), (9, 2)]),
             ([(7, 3), (2, 12)], [(7, 4), (7, 1.2), (2, 11), (3, 12)]), ([(-1, 900)], [(-1, 900)])]
    for members, regtypes in steps:
        left.add([member(*m) for m in members])
        right.add([regtype(*r) for r in regtypes])
        found = cogroup_stream(*sides(member_time(left.stream()), fact_time(right.stream())), ["uid"], earlier, schema, HotKeys(lanes=4))
        (found.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start().awaitTermination())
    l, r = sides(member_time(left.batch()), fact_time(right.batch()))
    expected = l.alias("l").join(r.alias("r"), ["uid", "win"], "left").where("uid > 0").groupBy("uid", "win", "register").agg(
        F.count_if(F.col("createtime") <= F.col("register")).cast("int").alias("before")).select("uid", "register", "before")
    assert Counter(map(tuple, spark.read.schema(schema).parquet(out).where("uid > 0").collect())) == Counter(map(tuple, expected.collect()))


def test_running_rows_after_a_replay_and_a_fold(spark):
    rows = spark.createDataFrame([("a", 1, 0), ("a", 2, 1), (None, 3, 2), ("a", 4, None), ("b", 5, 3)], "word string, id int, ms long")
    rows = rows.selectExpr("word", "id", "timestamp_millis(ms) AS ts")
    counts = RunningCount(spark, fresh_dir(spark, "running"), [rows.schema["word"]])
    counts.number(rows, 0, "ts", ["id"])
    more = spark.createDataFrame([("a", 6, 9), (None, 7, 9), (None, 8, 8), ("c", 9, 1)], "word string, id int, ms long")
    more = more.selectExpr("word", "id", "timestamp_millis(ms) AS ts")
    for _ in range(2):  # as after a failure between the writes and the end of the batch
        assert counts.totals.compact(before=1) in (True, False)
        counts.number(more, 1, "ts", ["id"])
    found = {r.id: (r.word, r.n) for r in counts.read(rows.schema).collect()}
    assert found == {4: ("a", 1), 1: ("a", 2), 2: ("a", 3), 3: (None, 1), 5: ("b", 1), 6: ("a", 4), 8: (None, 2), 7: (None, 3), 9: ("c", 1)}
    assert {r.key.word: r.n for r in counts.totals.read().collect()} == {"a": 4, None: 3, "b": 1, "c": 1}
