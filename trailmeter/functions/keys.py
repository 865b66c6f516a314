"""Keys and normalised values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trailmeter import constants as C


def normal_account(account: Column) -> Column:
    return F.lower(F.trim(account))


def identity(account: Column, device: Column, empty_account_is_missing: bool = True) -> Column:
    """The account, else the device. '' is no account, unless it is to count as one like any other."""
    if empty_account_is_missing:
        account = F.nullif(account, F.lit(""))
    return F.coalesce(account, device)


def whole_seconds(time: Column) -> Column:
    """Drop the fraction of a time string."""
    return F.split(time, r"\.")[0]


def click_session(kind: str = "ad_traffic_type") -> Column:
    """Click id for the traffic types that carry one, session id for the others."""
    return F.when(F.col(kind).isin(C.CLICK_ID_TYPES), F.col("click_id")).otherwise(F.col("sid"))


def click_item() -> Column:
    sku = F.col("ad_type") == C.SKU_AD_TYPE
    return F.when(sku, F.col("item_sku_id")).otherwise(F.col("material_id"))


def money(amount: Column) -> Column:
    return amount.cast(C.MONEY)


def shard_key(*columns: Column, shards: int = C.SHARDS) -> Column:
    """1..shards from the row's own values, so a retried task sends a row to the same shard."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    digits = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return (digits % shards + 1).cast("int")
