"""Text columns: addresses, keys, price labels, alert texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .casting import ColumnOrName, as_column

WHITESPACE = " \t\n\r\f\v"

# The texts of an alert and of the summary request, with their gaps in order.
ALERT_TEXT = (
    "🚨 *Stock-out Alert*\n"
    "%s\n\n"
    "_Details:_ store=%d, product=%d, date=%s, prob=%.2f, flag=%d"
)
SUMMARY_REQUEST = (
    "\n"
    "    Generate a short stock-out alert:\n"
    "\n"
    "    Store=%d\n"
    "    Product=%d\n"
    "    Date=%s\n"
    "    Probability=%.2f\n"
    "    Flag=%d\n"
    "\n"
    "    Use simple language + next action.\n"
    "    "
)


def lowered(value: ColumnOrName) -> Column:
    return F.lower(as_column(value).cast("string"))


def trimmed(value: ColumnOrName) -> Column:
    """Spaces only."""
    return F.trim(as_column(value))


def stripped(value: ColumnOrName) -> Column:
    """All ASCII whitespace, at both ends."""
    return F.btrim(as_column(value), F.lit(WHITESPACE))


def address_line(parts: Sequence[ColumnOrName]) -> Column:
    """Comma-joined parts without the missing ones.

    A part of blanks only is not missing: it leaves an empty slot.
    """
    kept = [F.when(as_column(p) != "", stripped(p)) for p in parts]
    return F.concat_ws(", ", *kept)


def business_key(store_id: ColumnOrName, address: ColumnOrName) -> Column:
    """The store id, or a digest of the address where the id is missing or blank."""
    store = as_column(store_id).cast("string")
    digest = F.sha2(F.coalesce(as_column(address), F.lit("")), 256)
    return F.when(stripped(store) != "", store).otherwise(
        F.concat(F.lit("addr_"), F.substring(digest, 1, 32))
    )


def item_url(prefix: str, item_id: ColumnOrName) -> Column:
    return F.concat(F.lit(prefix), as_column(item_id).cast("string"))


def clean_id(value: ColumnOrName) -> Column:
    """Id text without the '.0' that a float round trip leaves."""
    return F.regexp_replace(as_column(value).cast("string"), r"\.0$", "")


def short_id(prefix: str, *parts: ColumnOrName) -> Column:
    """Prefix and eight hex digits, the same for the same parts (so a retried task repeats it)."""
    joined = F.concat_ws("|", *[as_column(p).cast("string") for p in parts])
    return F.concat(F.lit(prefix), F.substring(F.md5(joined), 1, 8))


def price_text(low: ColumnOrName, high: ColumnOrName, is_range: ColumnOrName) -> Column:
    """'$a - $b' for a range, else '$a'; inputs are already rounded to cents."""
    low_text, high_text = (
        F.concat(F.lit("$"), as_column(price).cast("decimal(18,2)").cast("string")) for price in (low, high)
    )
    return F.when(
        as_column(low).isNotNull(),
        F.when(as_column(is_range), F.concat(low_text, F.lit(" - "), high_text)).otherwise(low_text),
    )


def alert_text(
    summary: ColumnOrName,
    store: ColumnOrName = "store_id",
    product: ColumnOrName = "product_id",
    day: ColumnOrName = "event_date",
    proba: ColumnOrName = "predicted_stockout_proba",
    flag: ColumnOrName = "predicted_stockout_flag",
) -> Column:
    return F.format_string(
        ALERT_TEXT,
        as_column(summary),
        as_column(store),
        as_column(product),
        as_column(day).cast("string"),
        as_column(proba),
        as_column(flag),
    )


def summary_request(
    store: ColumnOrName = "store_id",
    product: ColumnOrName = "product_id",
    day: ColumnOrName = "event_date",
    proba: ColumnOrName = "predicted_stockout_proba",
    flag: ColumnOrName = "predicted_stockout_flag",
) -> Column:
    return F.format_string(
        SUMMARY_REQUEST,
        as_column(store),
        as_column(product),
        as_column(day).cast("string"),
        as_column(proba),
        as_column(flag),
    )
