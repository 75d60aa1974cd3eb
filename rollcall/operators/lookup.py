"""Dimension lookups as left joins, with a record of what was not found."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from .skew import row_hash
from ..sources.dimensions import ad_dimension, vip_dimension, website_dimension


def lookup(rows: DataFrame, dimension: DataFrame, keys: Sequence[str], hit: str) -> DataFrame:
    """Add the columns of ``dimension`` and whether the key was found.

    ``dimension`` holds one row per key. No broadcast is forced: below
    ``spark.sql.autoBroadcastJoinThreshold`` Spark ships the dimension to the
    rows; a larger one is joined by sort-merge, where AQE splits a frequent key on
    the row side. Rows without a whole key match nothing: a hash of the row joins the
    key, so that they do not meet in one task where AQE is off, as in a stream.
    """
    whole_key = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    dealt = rows.selectExpr("*", f"IF({whole_key}, 0L, {row_hash(rows.columns)}) AS _alone")
    marked = dimension.withColumns({hit: F.lit(True), "_alone": F.lit(0).cast("long")})
    found = dealt.join(marked, [*keys, "_alone"], "left").withColumn(hit, F.coalesce(F.col(hit), F.lit(False)))
    return found.select(*rows.columns, *[c for c in marked.columns if c not in (*keys, "_alone")])


def lookup_ad(rows: DataFrame, ads: DataFrame) -> DataFrame:
    return lookup(rows, ad_dimension(ads), ("ad_id", "dn"), "ad_hit")


def lookup_website(rows: DataFrame, websites: DataFrame) -> DataFrame:
    """Rows without a site id match nothing, so nothing has to be skipped."""
    return lookup(rows, website_dimension(websites), ("siteid", "dn"), "site_hit")


def lookup_vip(rows: DataFrame, vips: DataFrame) -> DataFrame:
    return lookup(rows, vip_dimension(vips), ("vip_id", "dn"), "vip_hit")


def lookup_all(rows: DataFrame, ads: DataFrame, websites: DataFrame, vips: DataFrame) -> DataFrame:
    return lookup_vip(lookup_website(lookup_ad(rows, ads), websites), vips)


def missed_lookups() -> Column:
    """Comma-separated names of the lookups that had a key and found nothing; empty when all is well."""
    return F.concat_ws(
        ",",
        F.when(~F.col("ad_hit"), "ad"),
        F.when(F.col("siteid").isNotNull() & ~F.col("site_hit"), "site"),
        F.when(F.col("vip_id").isNotNull() & ~F.col("vip_hit"), "vip"),
    )


def dead_letters(rows: DataFrame, columns: Iterable[str] = ("uid", "dn", "ad_id", "siteid", "vip_id")) -> DataFrame:
    """Keys of the rows with a failed lookup. The rows themselves stay in the main output."""
    return rows.select(*columns, missed_lookups().alias("missed")).where(F.col("missed") != "")


def lookup_by_client(
    rows: DataFrame,
    open_client: Callable[[], object],
    fetch: Callable[[object, list[tuple]], dict[tuple, dict]],
    keys: Sequence[str],
    added: StructType,
    error: str = "lookup_error",
    seconds: float = 600,
) -> DataFrame:
    """Lookups in a store that can only be asked by key.

    Only the distinct keys go to Python, each is asked once, in requests of one
    Arrow batch with one client per task, and the answers are joined back. So no other
    column passes through pandas, and rows with a NULL in the key ask nothing. A request
    that fails or takes longer than ``seconds`` marks its rows in ``error``.
    """
    keys = list(keys)
    names = added.fieldNames()
    schema = StructType([*[rows.schema[k] for k in keys], *added.fields]).add(error, "string")

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, pool = open_client(), ThreadPoolExecutor(1)
        try:
            for batch in batches:
                wanted = list(batch[keys].astype(object).itertuples(index=False, name=None))
                try:
                    found, problem = pool.submit(fetch, client, wanted).result(seconds), None
                except Exception as failure:  # noqa: BLE001 - becomes a column of the result
                    found, problem = {}, f"{type(failure).__name__}: {failure}"
                    pool.shutdown(wait=False, cancel_futures=True)
                    pool = ThreadPoolExecutor(1)
                answers = [found.get(key, {}) for key in wanted]
                columns = {name: pd.Series([a.get(name) for a in answers], index=batch.index, dtype=object) for name in names}
                yield batch.assign(**columns, **{error: pd.Series([problem] * len(batch), index=batch.index, dtype=object)})
        finally:
            pool.shutdown(wait=False)
            close = getattr(client, "close", None)
            if close:
                close()

    whole_key = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    answers = rows.select(*keys).where(whole_key).distinct().mapInPandas(ask, schema)
    return rows.join(answers, keys, "left").select(*rows.columns, *names, error)
