"""Checks of filters, routing, words, aggregates and time windows in batches."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from rollcall.operators import latest, ordered, routing, windows, words
from rollcall.operators.joins import in_window
from rollcall.schemas import MEMBER
from rollcall.sources.typed import decode
from rollcall.streaming.event_time import with_event_time

from . import views
from .registry import check
from .views import names

TOPICS = """
log AS (
  SELECT CASE event_type WHEN 'signup' THEN 'member' WHEN 'click' THEN 'memberregtype'
              WHEN 'purchase' THEN 'memberpaymoney' WHEN 'view' THEN 'basewebsite' ELSE 'basead' END AS topic,
         event_id AS "offset" FROM ev
  UNION ALL SELECT 'membervip', o_orderkey FROM orders)"""


@check("flt1_json_object", f"""WITH {TOPICS},
junk AS (SELECT doc_id FROM documents WHERE (CASE WHEN json_valid(text) THEN json_type(text) = 'OBJECT' ELSE FALSE END))
SELECT topic, "offset" FROM log UNION ALL SELECT 'member', doc_id FROM junk""")
def flt1(spark, sf_dir):
    return routing.json_records(views.stored_log(spark, sf_dir)).select("topic", "offset")


@check("flt2_non_empty", r"""
WITH w AS (SELECT doc_id, unnest(string_split_regex(text, '\s')) AS word FROM documents)
SELECT * FROM w WHERE word <> ''""")
def flt2(spark, sf_dir):
    return words.non_empty(words.words_on_whitespace(views.lines(spark, sf_dir), keep=("doc_id",)))


@check("flt3_poison_guard", r"""
SELECT * FROM (SELECT doc_id, unnest(string_split_regex(text, '\s')) AS word FROM documents) WHERE word <> 'the'""")
def flt3(spark, sf_dir):
    """The guard would fail at a word that is frequent in the texts, had not a filter set it aside."""
    found = words.words_on_whitespace(views.lines(spark, sf_dir), keep=("doc_id",))
    return words.fail_on(found.where("word <> 'the'"), poison="the")


@check("rte1_facts", f"""WITH {TOPICS}
SELECT topic, "offset" FROM log WHERE topic NOT IN ('basead', 'basewebsite', 'membervip')
UNION ALL SELECT 'member', doc_id FROM documents""")
def rte1_facts(spark, sf_dir):
    return routing.split_by_layer(views.raw_log(spark, sf_dir))[0].select("topic", "offset")


@check("rte1_dimensions", f"""WITH {TOPICS}
SELECT topic, "offset" FROM log WHERE topic IN ('basead', 'basewebsite', 'membervip')""")
def rte1_dimensions(spark, sf_dir):
    return routing.split_by_layer(views.raw_log(spark, sf_dir))[1].select("topic", "offset")


@check("rte2_target_table", f"""WITH {TOPICS}
SELECT topic, CASE topic WHEN 'basewebsite' THEN 'dwd_basewebsite' WHEN 'basead' THEN 'dwd_basead'
       ELSE 'dwd_membervip' END AS target, count(*) AS n
FROM log WHERE topic IN ('basead', 'basewebsite', 'membervip') GROUP BY ALL""")
def rte2(spark, sf_dir):
    dims = routing.dimension_records(views.raw_log(spark, sf_dir))
    return dims.groupBy("topic", routing.target_table(F.col("topic")).alias("target")).agg(F.count("*").alias("n"))


@check("prj1_decode_member", f"SELECT {names('member')}, event_id AS \"offset\", 0 AS bad FROM member_all")
def prj1(spark, sf_dir):
    log = routing.json_records(views.stored_log(spark, sf_dir)).where(F.col("topic") == "member")
    return decode(log, MEMBER, keep=["offset"], bad_fields="bad")


@check("prj5_words_on_whitespace", r"""
WITH w AS (SELECT unnest(string_split_regex(text, '\s')) AS word FROM documents)
SELECT word, count(*) AS n FROM w GROUP BY word""")
def prj5(spark, sf_dir):
    return words.count_words(words.words_on_whitespace(views.lines(spark, sf_dir)))


@check("prj6_words_on_space", r"""
WITH w AS (SELECT doc_id, unnest(string_split(rtrim(text, ' '), ' ')) AS word
           FROM documents WHERE text = '' OR rtrim(text, ' ') <> '')
SELECT doc_id, word, count(*) AS n FROM w GROUP BY ALL""")
def prj6(spark, sf_dir):
    found = words.words_on_space(views.lines(spark, sf_dir), keep=("doc_id",))
    return found.groupBy("doc_id", "word").agg(F.count("*").alias("n"))


@check("prj7_with_one", r"SELECT unnest(string_split_regex(text, '\s')) AS word, 1 AS n FROM documents")
def prj7(spark, sf_dir):
    return words.with_one(words.words_on_whitespace(views.lines(spark, sf_dir)))


@check("prj8_labelled_counts", r"""
WITH w AS (SELECT unnest(string_split_regex(text, '\s')) AS word FROM documents)
SELECT word || '::' || count(*) AS value FROM w GROUP BY word""")
def prj8(spark, sf_dir):
    return words.labelled_counts(words.count_words(words.words_on_whitespace(views.lines(spark, sf_dir))))


@check("agg2_word_count", r"""
WITH w AS (SELECT unnest(string_split_regex(text, '\s')) AS word FROM documents)
SELECT word, count(*) AS n FROM w WHERE word <> '' GROUP BY word""")
def agg2(spark, sf_dir):
    found = words.non_empty(words.words_on_whitespace(views.lines(spark, sf_dir)))
    return words.sum_pairs(words.with_one(found))


_RUNNING = """
SELECT event_id, event_type, count(*) OVER (PARTITION BY event_type ORDER BY ts, event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n FROM events"""


@check("agg3_running_count", _RUNNING)
def agg3(spark, sf_dir):
    rows = views.table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    return ordered.running_count(rows, ["event_type"], "ts", ["event_id"]).drop("ts")


@check("agg3_running_count_ranges", _RUNNING)
def agg3_ranges(spark, sf_dir):
    """The same with each type cut into ranges by its rows."""
    rows = views.table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    return ordered.running_count_in_ranges(rows, ["event_type"], "ts", ["event_id"], rows_per_part=2_000).drop("ts")


@check("agg4_windowed_count", """
SELECT us // 5000000 * 5000000 AS start_us, us // 5000000 * 5000000 + 5000000 AS end_us, event_type AS word, count(*) AS n
FROM ev GROUP BY ALL""")
def agg4(spark, sf_dir):
    rows = views.events(spark, sf_dir).withColumnRenamed("event_type", "word")
    return windows.flat_window(words.count_words_in_windows(rows, "ts"))


@check("str1_event_time", "SELECT event_id, register, us FROM member_all")
def str1(spark, sf_dir):
    member = views.member(views.events(spark, sf_dir)).drop("ts")
    return with_event_time(member, "register").select("event_id", "register", F.unix_micros("ts").alias("us"))


@check("str4_tumbling", """
SELECT us // 600000000 * 600000000 AS start_us, us // 600000000 * 600000000 + 600000000 AS end_us, event_type, count(*) AS n
FROM ev GROUP BY ALL""")
def str4(spark, sf_dir):
    return windows.flat_window(windows.tumbling_counts(views.events(spark, sf_dir), ["event_type"], "ts"))


@check("str5_small_tumbling", "SELECT event_id, us // 10000000 * 10000000 AS win_us FROM ev")
def str5(spark, sf_dir):
    put = in_window(views.events(spark, sf_dir).select("event_id", "ts"), "ts", "10 seconds")
    return put.select("event_id", F.unix_micros("win.start").alias("win_us"))


@check("str6_sliding", """
WITH s AS (SELECT us // 5000000 * 5000000 - unnest([0, 5000000]) AS start_us, event_type FROM ev)
SELECT start_us, start_us + 10000000 AS end_us, event_type, count(*) AS n FROM s GROUP BY ALL""")
def str6(spark, sf_dir):
    return windows.flat_window(windows.sliding_counts(views.events(spark, sf_dir), ["event_type"], "ts"))


def session_sql(gap_us: int, key: str) -> str:
    return f"""
WITH g AS (SELECT {key}, us, CASE WHEN us - lag(us) OVER (PARTITION BY {key} ORDER BY us) <= {gap_us} THEN 0 ELSE 1 END AS opens FROM ev),
s AS (SELECT {key}, us, sum(opens) OVER (PARTITION BY {key} ORDER BY us ROWS UNBOUNDED PRECEDING) AS number FROM g)
SELECT {key}, min(us) AS start_us, max(us) + {gap_us} AS end_us, count(*) AS n FROM s GROUP BY {key}, number"""


@check("str7_sessions", session_sql(3_600_000_000, "user_id"))
def str7(spark, sf_dir):
    rows = views.events(spark, sf_dir)
    return ordered.sessions(rows, ["user_id"], "ts", gap="1 hour", slice_size="1 day")


@check("str7_sessions_five_seconds", session_sql(5_000_000, "event_type"))
def str7_short(spark, sf_dir):
    return ordered.sessions(views.events(spark, sf_dir), ["event_type"], "ts")


@check("str11_previous_login", """
WITH g AS (SELECT event_id, us, lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) AS before_us FROM ev)
SELECT event_id, CASE WHEN us - before_us <= 3600000000 THEN before_us END AS previous_us FROM g""")
def str11(spark, sf_dir):
    rows = views.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return ordered.previous_time(rows, ["user_id"], "ts", ["event_id"]).select("event_id", "previous_us")


@check("snk8_latest_rows", """
SELECT user_id, arg_max(event_id, ROW(us, event_id)) AS event_id, max(us) AS us FROM ev GROUP BY user_id""")
def snk8(spark, sf_dir):
    rows = views.events(spark, sf_dir).select("user_id", "event_id", "us")
    return latest.latest_rows(rows, ["user_id"], ["us", "event_id"])


@check("snk8_latest_values", """
SELECT uid, dn, arg_max(lastlogin, ROW(us, event_id)) FILTER (WHERE lastlogin IS NOT NULL) AS lastlogin,
       arg_max(userip, ROW(us, event_id)) AS userip, arg_max(event_id, ROW(us, event_id)) AS event_id, max(us) AS us
FROM member_all GROUP BY uid, dn""")
def snk8_values(spark, sf_dir):
    member = views.member(views.events(spark, sf_dir))
    rows = member.select("uid", "dn", "lastlogin", "userip", "event_id", F.unix_micros("ts").alias("us"))
    return latest.latest_values(rows, ["uid", "dn"], ["us", "event_id"])


def word_pairs(most: int = 20_000, most_chars: int = 1 << 20):
    """A flatMap, filter and map written by a user: (doc_id, word, 1) in frames of at most so many words, or a little over so many characters.

    The frames don't depend on how many or how long texts a batch has. Spark hands over batches of bounded size.
    """

    def frame(ids: list, found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(found, pa.string()), pa.array([1] * len(found), pa.int64())],
            names=["doc_id", "word", "n"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, found, chars = [], [], 0
        for batch in batches:
            for number, line in zip(batch.column("doc_id"), batch.column("line")):
                if not line.is_valid:
                    continue
                number = number.as_py()
                for match in re.finditer(r"[^ \t\n\x0b\f\r]+", line.as_py()):
                    ids.append(number)
                    found.append(match[0])
                    chars += len(match[0])
                    if len(found) >= most or chars >= most_chars:
                        yield frame(ids, found)
                        ids, found, chars = [], [], 0
        yield frame(ids, found)

    return pairs


@check("udf1_row_functions", r"""
WITH w AS (SELECT doc_id, unnest(string_split_regex(text, '\s')) AS word FROM documents)
SELECT doc_id, word, CAST(1 AS BIGINT) AS n FROM w WHERE word <> ''""")
def udf1(spark, sf_dir):
    """A user's own flatMap, filter and map, over Arrow batches.

    Words come in bounded frames, however many or long the texts of a batch are.
    """
    return views.lines(spark, sf_dir).mapInArrow(word_pairs(), "doc_id bigint, word string, n bigint")
