"""Code mappings and status predicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Agent name to kind of shadow order, and the kind of any other agent.
SHADOW_TYPES = {
    "亿程旅行社": "预付",
    "叮丁旅行社": "高返",
    "松果网": "松果",
    "代理": "代理",
}
SHADOW_DEFAULT = "现付"

# LIKE patterns over the operator id and the source they stand for,
# tried from the top; ``_`` matches any one character.
OPERATOR_SOURCES = (
    ("大户室与业务", ("%DHS&%",)),
    ("EBK", ("%EBK&%",)),
    (
        "直连",
        (
            "%SiteMinder%",
            "%JEYN%",
            "%Adapter%",
            "%TL_Lincoln%",
            "%CheckRoomAvailPoly%",
            "%Manager%",
            "%接口平台%",
            "%IHG%",
        ),
    ),
    ("自动开房", ("%BI_%",)),
    ("订单组", ("%ORD%",)),
    ("JobAuto", ("%JobwsAuto%",)),
    ("PriceChange", ("%RoomInfoByPriceChangeJob%",)),
    ("良好同步", ("%HtlRoomStatusSyncJob_良好同步%",)),
)
OPERATOR_UNKNOWN = "超出范围"
OPERATOR_OTHER = "其它"

CLOSED = "N"


def master_or_own(master: Column, own: Column) -> Column:
    """The master id when it is positive, else the record's own id."""
    return F.when(master > 0, master).otherwise(own)


def flag(condition: Column) -> Column:
    """1 or 0; an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def shadow_type(agent: Column) -> Column:
    known = reduce(
        lambda chain, pair: chain.when(agent == pair[0], F.lit(pair[1])),
        SHADOW_TYPES.items(),
        F.when(agent.isNull(), F.lit(None).cast("string")),
    )
    return known.otherwise(F.lit(SHADOW_DEFAULT))


def operator_source(operator: Column, sources: Sequence = OPERATOR_SOURCES) -> Column:
    chain = F
    for label, patterns in sources:
        hit = reduce(lambda a, b: a | b, (operator.like(p) for p in patterns))
        chain = chain.when(hit, F.lit(label))
    return chain.when(operator.isNull(), F.lit(OPERATOR_UNKNOWN)).otherwise(F.lit(OPERATOR_OTHER))


def is_close_event(old: Column, new: Column) -> Column:
    """Closed now, or closed before and the new status unknown."""
    return (new == CLOSED) | ((old == CLOSED) & new.isNull())


def touches_closed(old: Column, new: Column) -> Column:
    return (old == CLOSED) | (new == CLOSED)


def is_held(hold_room: Column, free_sale: Column) -> Column:
    return (hold_room == "T") | (free_sale == "T")


def bounded_code(code: Column, low: int = 0, high: int = 10) -> Column:
    """Codes outside the open interval become 0; a missing code stays missing."""
    return F.when((code <= low) | (code >= high), 0).otherwise(code)
