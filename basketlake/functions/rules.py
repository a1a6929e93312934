"""Row rules: cleaning conditions, customer segments, tiers, severities, freshness."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketlake.functions.parsers import parse_int

# Fixed value: the label put in place of a blank description or country.
UNKNOWN = "Unknown"


def known_text(c: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(UNKNOWN))


def customer_number(c: Column) -> Column:
    """Blank is a guest (NULL); '17850.0' is customer 17850."""
    return parse_int(c, "bigint")


def reject_reason() -> Column:
    """First rule a raw row breaks, NULL for a row worth keeping."""
    col = F.col
    return (
        F.when(col("invoice_no").isNull(), "missing_invoice_no")
        .when(col("stock_code").isNull(), "missing_stock_code")
        .when(col("invoice_date").isNull(), "filter_null_invoice_date")
        .when(col("unit_price").isNull() | (col("unit_price") <= 0), "filter_invalid_price")
        .when(col("quantity").isNull() | (col("quantity") == 0), "filter_zero_quantity")
        .when(_bad_customer(), "bad_customer_id")
    )


def _bad_customer() -> Column:
    text = F.trim(F.coalesce(F.col("customer_id"), F.lit("")))
    return (text != "") & customer_number(F.col("customer_id")).isNull()


@dataclass(frozen=True)
class CleaningRule:
    name: str
    target_column: str
    rule_type: str
    logic: str
    why: str
    touches: Callable[[], Column]


def _blank(name: str) -> Column:
    return F.trim(F.coalesce(F.col(name), F.lit(""))) == ""


# Rule names, targets and types of the rule catalogue.
CLEANING_RULES = [
    CleaningRule(
        "cancel_flag_invoice", "is_cancelled", "flag", "startswith(invoice_no, 'C')",
        "A cancelled invoice is no revenue but counts toward the cancellation rate.",
        lambda: F.col("invoice_no").startswith("C"),
    ),
    CleaningRule(
        "return_flag_quantity", "is_return", "flag", "quantity < 0",
        "Goods sent back are followed separately from sales.",
        lambda: F.col("quantity") < 0,
    ),
    CleaningRule(
        "filter_zero_quantity", "quantity", "filter", "quantity <> 0",
        "A line that moves no goods is an entry error.",
        lambda: F.col("quantity").isNull() | (F.col("quantity") == 0),
    ),
    CleaningRule(
        "null_customer_impute", "customer_id", "impute", "blank -> NULL, else whole number",
        "Guest purchases stay in revenue and leave customer analytics.",
        lambda: _blank("customer_id"),
    ),
    CleaningRule(
        "null_description_impute", "description", "impute", "blank -> 'Unknown'",
        "The article is still tracked by its stock code.",
        lambda: _blank("description"),
    ),
    CleaningRule(
        "null_country_impute", "country", "impute", "blank -> 'Unknown'",
        "Sales without a country stay in the totals.",
        lambda: _blank("country"),
    ),
    CleaningRule(
        "filter_invalid_price", "unit_price", "filter", "unit_price > 0",
        "Free and mispriced items distort revenue.",
        lambda: F.col("unit_price").isNull() | (F.col("unit_price") <= 0),
    ),
    CleaningRule(
        "derive_line_total", "line_total", "derive", "round(quantity * unit_price, 2)",
        "Extended price of the line, negative for returns.",
        lambda: reject_reason().isNull(),
    ),
    CleaningRule(
        "filter_null_invoice_date", "invoice_date", "filter", "invoice_date is not null",
        "A sale without a date has no place in a time series.",
        lambda: F.col("invoice_date").isNull(),
    ),
]


def _score_bands(cant_lose_first: bool) -> list[tuple[Column, str, str]]:
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    # Segment names, their texts and score bands, tested from the top.
    bands = [
        ((r >= 4) & (f >= 4) & (m >= 4), "Champions", "Best customers, high value and engagement"),
        ((r >= 4) & (f >= 3) & (m >= 3), "Loyal Customers", "Consistent buyers, respond to promotions"),
        ((r >= 4) & (f <= 2), "Recent Customers", "New buyers, need nurturing"),
        ((r >= 3) & (f >= 3) & (m >= 3), "Potential Loyalists", "Recent with potential, offer membership"),
        ((r >= 3) & (f >= 1) & (m >= 2), "Promising", "Recent but low frequency, engage more"),
        (r.between(2, 3) & (f <= 2) & (m <= 2), "Needs Attention", "Above average but declining"),
        ((r <= 2) & (f >= 3), "At Risk", "Used to be active, reactivation needed"),
        ((r <= 2) & (f >= 4) & (m >= 4), "Cant Lose Them", "High value at risk, urgent action"),
        ((r <= 2) & (f <= 2), "Hibernating", "Low activity, may be lost"),
    ]
    if cant_lose_first:
        bands[6], bands[7] = bands[7], bands[6]
    return bands


def rfm_segment(corrected: bool = False) -> Column:
    """Segment name from the three scores.

    In the usual order 'Cant Lose Them' can never match, because 'At Risk' is
    tested before it; ``corrected=True`` swaps the two.
    """
    out = F
    for cond, name, _ in _score_bands(corrected):
        out = out.when(cond, name)
    return out.otherwise("Others")


def segment_description(corrected: bool = False) -> Column:
    out = F
    for cond, _, text in _score_bands(corrected):
        out = out.when(cond, text)
    return out.otherwise("Requires further analysis")


def revenue_tier(rank: Column) -> Column:
    # Tier edges and labels.
    return (
        F.when(rank <= 10, "Top 10")
        .when(rank <= 50, "Top 11-50")
        .when(rank <= 100, "Top 51-100")
        .otherwise("Others")
    )


def severity_order(severity: Column) -> Column:
    return (
        F.when(severity == "critical", 1)
        .when(severity == "high", 2)
        .when(severity == "medium", 3)
        .otherwise(4)
    )


def hours_between(now: Column, then: Column) -> Column:
    """Hours as a double; both sides are timestamps without zone."""
    return F.timestamp_diff("MICROSECOND", then, now) / F.lit(3.6e9)


def freshness_status(now: Column, then: Column) -> Column:
    hours = hours_between(now, then)
    return F.when(hours < 6, "fresh").when(hours < 24, "stale").otherwise("outdated")


def date_key(d: Column) -> Column:
    """YYYYMMDD as an integer, by arithmetic (no text formatting per row)."""
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)
