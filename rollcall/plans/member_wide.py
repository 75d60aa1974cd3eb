"""The wide member row: facts joined inside windows, dimensions looked up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import salted_row_key
from ..operators.joins import (
    WINDOW, join_member_facts, member_side, payment_side, regtype_side,
)
from ..operators.latest import latest_values
from ..operators.lookup import lookup_ad, lookup_all, lookup_vip, lookup_website
from ..operators.projection import MEMBER_COLUMNS, PAYMENT_COLUMNS, REGTYPE_COLUMNS, wide_row
from ..operators.skew import HotKeys
from ..schemas import MEMBER_KEY, WIDE_MEMBER
from ..sinks.upsert_table import CellTable

HITS = ("ad_hit", "site_hit", "vip_hit")
#: Time of a record and its number, which decides between records of one time.
MEMBER_ORDER, REGTYPE_ORDER, PAYMENT_ORDER = (("member_us", "member_tie"), ("regtype_us", "regtype_tie"), ("payment_us", "payment_tie"))
ORDERS = (*MEMBER_ORDER, *REGTYPE_ORDER, *PAYMENT_ORDER)
#: Columns of the website that are stored beside the wide row.
STORED_EXTRA = ("delete", "site_creator")
_WIDE_TABLE = StructType([
    StructField("row_key", StringType()), *WIDE_MEMBER.fields, *[StructField(name, StringType()) for name in STORED_EXTRA]])


def _found_columns(looked_up: DataFrame, rows: DataFrame) -> list[str]:
    return [c for c in looked_up.columns if c not in rows.columns]


def _no_hit_is_false(rows: DataFrame) -> DataFrame:
    return rows.withColumns({hit: F.coalesce(F.col(hit), F.lit(False)) for hit in HITS})


def wide_rows(
    member: DataFrame, regtype: DataFrame, payment: DataFrame,
    ads: DataFrame, websites: DataFrame, vips: DataFrame,
    ts: str = "ts", size: str = WINDOW, hot_keys: HotKeys | None = HotKeys(),
    mask: Sequence[str] = (),
) -> DataFrame:
    """All pairs as wide rows with hit flags.

    A lookup needs columns of one side only, so it is done on that side, before
    the joins multiply its rows.
    """
    members = lookup_ad(member, ads)
    payments = lookup_vip(lookup_website(payment, websites), vips)
    joined = join_member_facts(
        members, regtype, payments, ts, size, hot_keys,
        member_extra=_found_columns(members, member), payment_extra=_found_columns(payments, payment),
        counted=(member, regtype, payment),
    )
    return wide_row(_no_hit_is_false(joined), mask=mask, keep=HITS)


def enrich(joined: DataFrame, ads: DataFrame, websites: DataFrame, vips: DataFrame) -> DataFrame:
    """Look the dimensions up for rows that are joined already, as a stream gives them."""
    return lookup_all(joined, ads, websites, vips)


def collapse_member(member: DataFrame) -> DataFrame:
    """One row per member, site and window: the last value of each column."""
    return latest_values(member, (*MEMBER_KEY, "win"), MEMBER_ORDER)


def collapse_right(side: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    return latest_values(side.select(*MEMBER_KEY, "win", *columns, *order), (*MEMBER_KEY, "win"), order)


def current_members(
    member: DataFrame, regtype: DataFrame, payment: DataFrame,
    ads: DataFrame, websites: DataFrame, vips: DataFrame, ts: str = "ts", size: str = WINDOW,
) -> DataFrame:
    """The wide table as the upserts of all pairs leave it, without forming the pairs.

    In a window the last value of a column is that of the last row of its own
    side. So each side is first reduced to one row per member, site and window,
    before its shuffle; then the joins are one to one and need no further one.
    A member with a third of all rows costs one row per task and window. Records
    without a time are in no window and leave no value, as in the upserts.
    """
    members = lookup_ad(member, ads)
    payments = lookup_vip(lookup_website(payment, websites), vips)
    ad_columns = _found_columns(members, member)
    pay_columns = _found_columns(payments, payment)
    left = member_side(members, ts, size).select(*MEMBER_COLUMNS, *ad_columns, *MEMBER_ORDER, "win")
    right_reg = regtype_side(regtype, ts, size)
    right_pay = payment_side(payments, ts, size)
    keys = [*MEMBER_KEY, "win"]
    joined = (
        collapse_member(left)
        .join(collapse_right(right_reg, REGTYPE_COLUMNS, REGTYPE_ORDER), keys, "left")
        .join(collapse_right(right_pay, (*PAYMENT_COLUMNS, *pay_columns), PAYMENT_ORDER), keys, "left")
    )
    order = joined.select(*joined.columns, F.unix_micros("win.start").alias("_win_us")).drop("win", *ORDERS)
    return with_row_key(wide_row(latest_values(order, MEMBER_KEY, ("_win_us",)), keep=_quoted(STORED_EXTRA)))


#: Ids that a side looks dimensions up by.
MEMBER_IDS, PAYMENT_IDS = ("ad_id",), ("siteid", "vip_id")


def collapse_with_ids(side: DataFrame, columns: Sequence[str], order: Sequence[str], ids: Sequence[str], name: str) -> DataFrame:
    """One row per member, site and window: the last value of each column, and in ``name`` every id with the last time it came.

    Rows are reduced per id first, so what is kept of a member in a window is as long as the list of its different ids.
    Each value carries its time through both steps.
    """
    keys = [*MEMBER_KEY, "win"]
    when = ", ".join(f"`{c}`" for c in order)
    others = [c for c in columns if c not in ids]
    dated = side.selectExpr(
        *keys, *ids, f"struct({when}) AS _order",
        *[f"IF(`{c}` IS NULL, NULL, struct({when}, `{c}` AS value)) AS `{c}`" for c in others])
    per_id = dated.groupBy(*keys, *ids).agg(F.max("_order").alias("_order"), *[F.max(c).alias(c) for c in others])
    last = [F.expr(f"max(IF(`{c}` IS NULL, NULL, struct(_order, `{c}` AS value))) AS `{c}`") for c in ids]
    listed = F.expr(f"collect_list(struct({', '.join(f'`{c}`' for c in ids)}, _order)) AS `{name}`")
    merged = per_id.groupBy(*keys).agg(F.max("_order").alias("_order"), *[F.max(c).alias(c) for c in others], *last, listed)
    return merged.selectExpr(
        *keys, *[f"`{c}`.value AS `{c}`" for c in columns], *[f"_order.`{c}` AS `{c}`" for c in order],
        f"transform(`{name}`, x -> struct({', '.join(f'x.`{c}`' for c in ids)}, {', '.join(f'x._order.`{c}`' for c in order)})) AS `{name}`")


def collapsed_streams(
    member: DataFrame, regtype: DataFrame, payment: DataFrame, ts: str = "ts", size: str = WINDOW,
) -> DataFrame:
    """Stream: one row per member, site and window, with the last values of all three sides and all their lookup ids.

    Each side is an aggregation by window first, so its rows are reduced before
    the shuffle and the join keeps one row of state per key instead of all. The
    lookups follow in the batch: see ``with_each_id``.
    """
    keys = [*MEMBER_KEY, "win"]
    values = [c for c in MEMBER_COLUMNS if c not in MEMBER_KEY]
    joined = (
        collapse_with_ids(member_side(member, ts, size), values, MEMBER_ORDER, MEMBER_IDS, "member_ids")
        .join(collapse_right(regtype_side(regtype, ts, size), REGTYPE_COLUMNS, REGTYPE_ORDER), keys, "left")
        .join(collapse_with_ids(payment_side(payment, ts, size), PAYMENT_COLUMNS, PAYMENT_ORDER, PAYMENT_IDS, "payment_ids"), keys, "left")
    )
    return joined.drop("win")


def with_each_id(collapsed: DataFrame) -> DataFrame:
    """Collapsed rows, each followed by a row for every id that a side has: of all pairs what the lookups depend on.

    A dimension may not know the last id of a window but an earlier one. In a table that ignores NULLs these rows
    leave the last value that was found, as all pairs would.
    """
    rows = collapsed.drop("member_ids", "payment_ids")
    members = collapsed.select(*MEMBER_KEY, F.inline("member_ids"))
    payments = collapsed.select(*MEMBER_KEY, *MEMBER_ORDER, F.inline("payment_ids"))
    return rows.unionByName(members, allowMissingColumns=True).unionByName(payments, allowMissingColumns=True)


def with_row_key(wide: DataFrame) -> DataFrame:
    return wide.select(salted_row_key(F.col("uid"), F.col("dn")).alias("row_key"), *wide.columns)


def wide_table(spark: SparkSession, path: str) -> CellTable:
    """The stored wide table."""
    return CellTable(spark, path, _WIDE_TABLE, ("row_key", *MEMBER_KEY))


def _value_orders() -> dict[str, tuple[str, str]]:
    """Each value of the wide row is as old as the record it comes from."""
    orders = {name: PAYMENT_ORDER for name in (*WIDE_MEMBER.fieldNames(), *STORED_EXTRA)}
    orders |= {name: MEMBER_ORDER for name in (*MEMBER_COLUMNS, "adname")}
    orders |= {name: REGTYPE_ORDER for name in REGTYPE_COLUMNS}
    return orders


def upsert_members(enriched: DataFrame, batch_id: int, table: CellTable) -> None:
    """Write the enriched pairs of one batch into the wide table."""
    rows = enriched.where("member_us IS NOT NULL")
    table.upsert(with_row_key(wide_row(rows, keep=_quoted((*ORDERS, *STORED_EXTRA)))), batch_id, _value_orders())


def _quoted(names: Sequence[str]) -> list[str]:
    return [f"`{name}`" for name in names]
