"""Gold builders: bridge joins and group-by aggregates.

Builders take a mapping of table name -> DataFrame and return a lazy frame, so the
same builder serves a full replace and a CDC merge.  No join hints: Catalyst and
AQE choose broadcast or sort-merge from sizes, and AQE splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from lakeload.operators.change_feed import CHANGE_TYPE, INSERT, POST

#: Sign of a changed row: +1 for what a table gained, -1 for what it lost.
SIGN = "_sign"


def candidate_by_campaign(
    candidate: DataFrame,
    bridge: DataFrame,
    campaign: DataFrame,
    *,
    cand_id: str,
    cand_name: str,
    cand_company: str,
    lead_id: str,
    campaign_id: str,
    bridge_status: str,
    camp_id: str,
    camp_name: str,
    camp_start: str | None,
    camp_end: str | None,
    with_delete_flag: bool = False,
) -> DataFrame:
    """candidate ⋈ bridge ⋈ campaign (inner, on id = lead id and campaign id = id).

    Output: LeadId, CampaignId, Candidate, Company, Status, Campaign,
    StartDateCampaign, EndDateCampaign (+ IsDeleted = false for the CDC view).
    Only the columns used are read from each input.
    """
    c = candidate.select(F.col(cand_id).alias("__cid"), F.col(cand_name).alias("Candidate"), F.col(cand_company).alias("Company"))
    b = bridge.select(F.col(lead_id).alias("__lid"), F.col(campaign_id).alias("__bcid"), F.col(bridge_status).alias("Status"))
    start = F.col(camp_start) if camp_start else F.lit(None).cast("date")
    end = F.col(camp_end) if camp_end else F.lit(None).cast("date")
    k = campaign.select(
        F.col(camp_id).alias("__kid"), F.col(camp_name).alias("Campaign"),
        start.alias("StartDateCampaign"), end.alias("EndDateCampaign"),
    )
    out = (
        c.join(b, F.col("__cid") == F.col("__lid"), "inner")
        .join(k, F.col("__bcid") == F.col("__kid"), "inner")
        .select(
            F.col("__cid").alias("LeadId"), F.col("__kid").alias("CampaignId"), "Candidate", "Company",
            "Status", "Campaign", "StartDateCampaign", "EndDateCampaign",
        )
    )
    if with_delete_flag:
        out = out.withColumn("IsDeleted", F.lit(False))
    return out


def status_count(df: DataFrame, status_col: str, with_delete_flag: bool = False) -> DataFrame:
    """``select status, count(*) cnt_status_campaign group by status`` (null is a group)."""
    out = df.groupBy(F.col(status_col).alias("status")).agg(F.count(F.lit(1)).alias("cnt_status_campaign"))
    if with_delete_flag:
        out = out.withColumn("IsDeleted", F.lit(False))
    return out


def group_count(df: DataFrame) -> DataFrame:
    """Number of groups of a grouped frame, null group included (not countDistinct)."""
    return df.agg(F.count(F.lit(1)).alias("regs"))


def billing_per_customer(
    orders: DataFrame,
    items: DataFrame,
    customers: DataFrame,
    *,
    order_id: str,
    order_customer: str,
    item_order: str,
    quantity: str,
    list_price: str,
    discount: str,
    customer_id: str,
    group_cols: Sequence[str],
    order_cols: Sequence[str],
    decimals: int = 2,
) -> DataFrame:
    """sum(quantity * list_price) as billing, sum(discount) as discount per customer.

    Sums are exact: amounts are taken as whole numbers of their smallest unit, summed
    as ``bigint`` (ANSI mode fails on overflow rather than wrap) and scaled back to
    double once per output row.  A decimal column counts in units of its own scale, so
    nothing is rounded; decimals too wide for a ``bigint`` product are summed as
    ``decimal(38,0)``.  Other columns count in units of 10^-decimals (cents by default).

    The plan aggregates eagerly: line items are summed per order before the join
    with orders, and per customer id before the join with customers, so the big
    shuffles carry partial sums instead of rows; a final group-by on the output
    columns keeps the result exact when several customer ids share a name.
    """
    kinds = {c: items.schema[c].dataType for c in (quantity, list_price, discount)}
    unit = {c: 10 ** (k.scale if isinstance(k, DecimalType) else decimals) for c, k in kinds.items()}

    def units(c: str, *others: str):
        k = kinds[c]
        if not isinstance(k, DecimalType):
            return F.round(F.col(c) * unit[c]).cast("bigint")
        digits = sum(kinds[x].precision if isinstance(kinds[x], DecimalType) else 0 for x in (c, *others))
        scaled = F.col(c).cast(f"decimal(38,{k.scale})") * F.lit(unit[c]).cast(f"decimal({k.scale + 1},0)") if digits > 18 else F.col(c) * F.lit(unit[c])
        return scaled.cast("decimal(38,0)" if digits > 18 else "bigint")

    per_order = items.groupBy(F.col(item_order).alias("__oid")).agg(
        F.sum(units(quantity, list_price) * units(list_price, quantity)).alias("__bill"),
        F.sum(units(discount)).alias("__disc"),
    )
    o = orders.select(F.col(order_id).alias("__oid"), F.col(order_customer).alias("__cust"))
    per_customer = (
        per_order.join(o, "__oid", "inner")
        .groupBy("__cust")
        .agg(F.sum("__bill").alias("__bill"), F.sum("__disc").alias("__disc"))
    )
    cust = customers.select(F.col(customer_id).alias("__cust"), *group_cols)
    out = (
        per_customer.join(cust, "__cust", "inner")
        .groupBy(*group_cols)
        .agg(
            (F.sum("__bill").cast("double") / float(unit[quantity] * unit[list_price])).alias("billing"),
            (F.sum("__disc").cast("double") / float(unit[discount])).alias("discount"),
        )
    )
    return out.orderBy(*order_cols)


def signed(feed: DataFrame) -> DataFrame:
    """Rows of a change feed with their sign instead of their change type."""
    gained = F.col(CHANGE_TYPE).isin(INSERT, POST)
    return feed.withColumn(SIGN, F.when(gained, F.lit(1)).otherwise(F.lit(-1))).drop(CHANGE_TYPE)


def status_delta(feed: DataFrame, status_col: str) -> DataFrame:
    """What a table's change feed adds to ``status_count`` (null is a group)."""
    return signed(feed).groupBy(F.col(status_col).alias("status")).agg(F.sum(SIGN).alias("cnt_status_campaign"))


def apply_count_delta(counts: DataFrame, delta: DataFrame) -> DataFrame:
    """Counts with a delta added; groups without rows go."""
    both = counts.select("status", "cnt_status_campaign").unionByName(delta)
    return both.groupBy("status").agg(F.sum("cnt_status_campaign").alias("cnt_status_campaign")).filter("cnt_status_campaign <> 0")


def candidate_delta(old: Mapping[str, DataFrame], new: Mapping[str, DataFrame], feeds: Mapping[str, DataFrame], **columns) -> DataFrame:
    """Signed rows by which ``candidate_by_campaign`` changes, by delta joins.

    ``old`` and ``new`` hold ``candidate``, ``bridge`` and ``campaign`` before and after, ``feeds``
    the change feeds of those that changed.  Each feed joins the other two tables, the ones
    before it already changed and the ones after it not yet, so a change in several tables
    counts once.  Only feeds drive the joins; the view itself is never rebuilt.
    """
    names = ("candidate", "bridge", "campaign")
    parts = []
    for i, name in enumerate(names):
        if name not in feeds:
            continue
        sides = {n: (new if j < i else old)[n] for j, n in enumerate(names) if j != i}
        change = signed(feeds[name])
        for sign in (1, -1):
            rows = candidate_by_campaign(**{**sides, name: change.filter(F.col(SIGN) == sign)}, **columns)
            parts.append(rows.withColumn(SIGN, F.lit(sign)))
    return union_all(parts)


def apply_row_delta(view: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``view`` with signed rows added: only rows of the delta's keys are grouped, the others pass through."""
    cols = view.columns
    touched = delta.select(*keys).distinct()
    near = view.join(touched, list(keys), "left_semi").select(*cols, F.lit(1).alias(SIGN)).unionByName(delta.select(*cols, SIGN))
    times = near.groupBy(*cols).agg(F.sum(SIGN).cast("int").alias(SIGN)).filter(F.col(SIGN) > 0)
    changed = times.select(*cols, F.explode(F.array_repeat(F.lit(1), F.col(SIGN))).alias("__x")).drop("__x")
    return view.join(touched, list(keys), "left_anti").select(*cols).unionByName(changed)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
