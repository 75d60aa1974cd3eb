"""Left joins of member streams inside event-time windows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from ..schemas import MEMBER_KEY
from .projection import MEMBER_COLUMNS, PAYMENT_COLUMNS, REGTYPE_COLUMNS, without_member_amount
from .skew import PART, HotKeys, deal_streams, key_counts, row_hash, spread

WINDOW = "10 minutes"
SMALL_WINDOW = "10 seconds"
_JOIN_KEY = (*MEMBER_KEY, "win")


def in_window(df: DataFrame, ts: str, size: str = WINDOW, us: str = "us") -> DataFrame:
    """Put each row into its tumbling window ``win``, aligned to the epoch.

    The time itself stays as a plain number ``us``: a stream may carry only one
    event-time column into an outer join, and that is the window. Rows without a
    time belong to no window and are left out; ``without_event_time`` finds them,
    and the joins below keep those of a left batch.
    """
    return (
        df.withColumn(us, F.unix_micros(F.col(ts)))
        .withColumn("win", F.window(F.col(ts), size))
        .drop(ts)
    )


def without_event_time(df: DataFrame, ts: str) -> DataFrame:
    return df.where(F.col(ts).isNull())


def with_untimed(joined: DataFrame, left: DataFrame, ts: str) -> DataFrame:
    """A left join in windows with the left rows that have no time, as rows without a match.

    For batches. In a stream they would be kept back for ever: see ``jobs.start_untimed_stream``.
    """
    if joined.isStreaming:
        return joined
    untimed = without_event_time(left, ts)
    kept = untimed.select(*[c for c in untimed.columns if c in joined.columns])
    return joined.unionByName(kept, allowMissingColumns=True)


def left_join_chain(
    left: DataFrame,
    rights: Sequence[tuple[DataFrame, Sequence[str]]],
    keys: Sequence[str] = _JOIN_KEY,
    hot_keys: HotKeys | None = HotKeys(),
    counted: Sequence[DataFrame] | None = None,
) -> DataFrame:
    """left ⟕ rights[0] ⟕ rights[1] ..., all on the same keys, all pairs.

    In a batch every input is shuffled at most once: the joins share the partitioning,
    and hot keys are spread first. Streams are dealt out by ``deal_streams``, if the window is one of the
    keys; with ``hot_keys=None`` they are joined as they are. Left rows without
    a whole key match nothing: a hash of the row joins the key, so that they do not
    meet in one task.
    """
    streams = [side.isStreaming for side in (left, *[side for side, _ in rights])]
    streaming = any(streams)
    dealt = None
    whole_key = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    sides = [left, *[side.where(whole_key).select(*keys, *columns) for side, columns in rights]]
    if hot_keys is not None and not streaming:
        dealt = spread(sides, keys, hot_keys, counted)
    elif hot_keys is not None and all(streams) and "win" in keys:
        dealt = deal_streams(sides[0], sides[1:], keys, hot_keys)
    on = [*keys, "_alone", *([PART] if dealt else [])]
    joined = (dealt or sides)[0].selectExpr("*", f"IF({whole_key}, 0L, {row_hash(left.columns)}) AS _alone")
    for number, side in enumerate((dealt or sides)[1:], start=1):
        hit = f"_hit{number}"
        joined = joined.join(side.selectExpr("*", "0L AS _alone", f"true AS {hit}"), on, "left")
        if dealt and not streaming:
            joined = joined.where(f"NOT _split{number} OR {hit}")
    return joined.select(*left.columns, *[c for _, columns in rights for c in columns])


def _with_tie(side: DataFrame, columns: Iterable[str], tie: str) -> DataFrame:
    """A number of the record, to put records of one time in an order that is the same everywhere."""
    return side.withColumn(tie, F.expr(row_hash([c for c in (*MEMBER_KEY, *columns) if c in side.columns])))


def member_side(member: DataFrame, ts: str, size: str = WINDOW) -> DataFrame:
    return _with_tie(in_window(without_member_amount(member), ts, size, "member_us"), MEMBER_COLUMNS, "member_tie")


def regtype_side(regtype: DataFrame, ts: str, size: str = WINDOW) -> DataFrame:
    side = in_window(regtype.withColumnRenamed("createtime", "regtype_createtime"), ts, size, "regtype_us")
    return _with_tie(side, REGTYPE_COLUMNS, "regtype_tie")


def payment_side(payment: DataFrame, ts: str, size: str = WINDOW) -> DataFrame:
    return _with_tie(in_window(payment, ts, size, "payment_us"), PAYMENT_COLUMNS, "payment_tie")


def join_regtype(
    member: DataFrame, regtype: DataFrame, ts: str = "ts", size: str = WINDOW,
    hot_keys: HotKeys | None = HotKeys(),
) -> DataFrame:
    """Member rows with the registration type of the same member, site and window."""
    left = member_side(member, ts, size)
    right = regtype_side(regtype, ts, size)
    joined = left_join_chain(left, [(right, (*REGTYPE_COLUMNS, "regtype_us", "regtype_tie"))], hot_keys=hot_keys)
    return with_untimed(joined, member, ts)


def join_payment(
    joined: DataFrame, payment: DataFrame, ts: str = "ts", size: str = WINDOW,
    hot_keys: HotKeys | None = HotKeys(), counted: DataFrame | None = None,
) -> DataFrame:
    """Rows that are in a window already, with the payments of the same member, site and window.

    ``counted`` gives the member rows that ``joined`` comes from, which are cheaper to count.

    Streams are joined as they are: dealing them out would run what ``joined`` comes from twice. ``join_member_facts``
    deals out the member rows once for both joins.
    """
    hot_keys = None if joined.isStreaming else hot_keys
    right = payment_side(payment, ts, size)
    base = None if counted is None else [in_window(counted, ts, size), right]
    return left_join_chain(joined, [(right, (*PAYMENT_COLUMNS, "payment_us", "payment_tie"))], hot_keys=hot_keys, counted=base)


def join_member_facts(
    member: DataFrame, regtype: DataFrame, payment: DataFrame, ts: str = "ts", size: str = WINDOW,
    hot_keys: HotKeys | None = HotKeys(), member_extra: Iterable[str] = (), payment_extra: Iterable[str] = (),
    counted: Sequence[DataFrame] | None = None,
) -> DataFrame:
    """Both joins as one chain over three shuffles. The extra columns come along from their side.

    ``counted`` gives member, registration and payment rows as they were before any lookups.
    """
    left = member_side(member, ts, size).select(*MEMBER_COLUMNS, *member_extra, "member_us", "member_tie", "win")
    joined = left_join_chain(
        left,
        [
            (regtype_side(regtype, ts, size), (*REGTYPE_COLUMNS, "regtype_us", "regtype_tie")),
            (payment_side(payment, ts, size), (*PAYMENT_COLUMNS, *payment_extra, "payment_us", "payment_tie")),
        ],
        hot_keys=hot_keys,
        counted=[in_window(rows, ts, size) for rows in counted] if counted else None,
    )
    return with_untimed(joined, member, ts)


def cogroup(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    function,
    schema: StructType | str,
    hot_keys: HotKeys | None = HotKeys(),
    rows_per_call: int | None = None,
) -> DataFrame:
    """Apply ``function(left_rows, right_rows)`` to the rows of each key of the left side.

    For logic a join cannot say. The function has to treat left rows one by one,
    to give nothing where there are none, and to give for several right rows what
    it gives for each of them: then a hot key can be dealt out over several calls.
    With ``hot_keys=None`` every call gets a whole group, of keys of either side,
    and that group has to fit into one task.

    A call per key is slow where keys are many and small. With ``rows_per_call`` a call
    gets the rows of many keys, about so many of both sides, and the function has to
    keep them apart, as a merge on the keys does. For that the rows are counted.
    """
    left_columns, right_columns = left.columns, right.columns
    keys = list(keys)

    if hot_keys is None:
        def whole(left_rows: pd.DataFrame, right_rows: pd.DataFrame) -> pd.DataFrame:
            return function(left_rows, right_rows)

        return _cogrouped(left, right, keys).applyInPandas(whole, schema)

    counts = key_counts([left, right], keys)
    dealt = spread([left, right], keys, hot_keys, counts=counts)
    left_dealt, right_dealt = dealt or [side.withColumns({PART: F.lit(0), "_split1": F.lit(False)}) for side in (left, right)]
    together = [*keys, PART]
    if rows_per_call is None:
        grouped = together
    else:
        grouped = ["_bucket"]
        buckets = max(1, -(-counts.rows // rows_per_call))
        bucket = f"pmod(xxhash64({', '.join(together)}), {int(buckets)}) AS _bucket"
        left_dealt, right_dealt = (side.selectExpr("*", bucket) for side in (left_dealt, right_dealt))

    def one_part(left_rows: pd.DataFrame, right_rows: pd.DataFrame) -> pd.DataFrame:
        """Rows of one part, of one key or of several."""
        split = left_rows["_split1"]
        if split.any():  # the right rows of such a key may all be in other parts
            here = left_rows[keys].merge(right_rows[keys].drop_duplicates(), on=keys, how="left", indicator=True)
            left_rows = left_rows[~split.to_numpy() | (here["_merge"] == "both").to_numpy()]
        if left_rows.empty:
            right_rows = right_rows.iloc[:0]
        return function(left_rows[left_columns], right_rows[right_columns])

    def by_part(left_rows: pd.DataFrame, right_rows: pd.DataFrame) -> pd.DataFrame:
        """A bucket can hold several parts of a key, which must not meet."""
        # Left rows without a whole key match nothing and can go with any part.
        number = left_rows[PART].where(left_rows[keys].notna().all(axis=1), 0)
        results = [
            one_part(left_rows[number == part], right_rows[right_rows[PART] == part])
            for part in sorted(set(number))
        ]
        return pd.concat(results) if results else one_part(left_rows, right_rows)

    apply = one_part if rows_per_call is None else by_part
    return _cogrouped(left_dealt, right_dealt, grouped).applyInPandas(
        lambda left_rows, right_rows: apply(left_rows, right_rows), schema)


def _cogrouped(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    # A call per group costs far more than its bytes suggest, so do not let AQE
    # merge small partitions; a number of its own keeps it from doing so.
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (left.repartition(tasks, *keys).groupBy(*keys)
            .cogroup(right.repartition(tasks, *keys).groupBy(*keys)))
