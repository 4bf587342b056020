"""From the wide feature row to the matrix a model trains on."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.functions.calendar import HOLIDAYS_2016, days_to_holiday, is_weekend
from nightledger.functions.codes import bounded_code
from nightledger.functions.ratios import LEVELS, accepted, caller_ratios
from nightledger.operators.prep import dummies, fit_categories, fit_standardizer, standardize
from nightledger.session import stored

SCOPES = ("30d", "efdt30d")


@dataclass(frozen=True)
class Columns:
    """Columns that go in as they are, columns that are standardised, and columns that are coded.

    ``supplied`` go in as they are, and ``supplied_coded`` are coded, where the features have them: no step here makes them.
    """

    direct: tuple[str, ...]
    scaled: tuple[str, ...] = ()
    coded: tuple[str, ...] = ()
    supplied: tuple[str, ...] = ()
    supplied_coded: tuple[str, ...] = ()

    def given(self, available: Sequence[str]) -> Columns:
        """The same with what the caller supplies among the columns that are needed."""
        have = set(available)
        return replace(
            self,
            direct=(*self.direct, *(c for c in self.supplied if c in have)),
            coded=(*self.coded, *(c for c in self.supplied_coded if c in have)),
            supplied=(),
            supplied_coded=(),
        )


# The columns that models train on. Names are level, measure and scope.
STANDARDISED = Columns(
    direct=(
        "mbr_fullpct_30d",
        "mbr_force_fullpct_30d",
        "mhtl_fullpct_30d",
        "mhtl_force_fullpct_30d",
        "mbr_fullpct_efdt30d",
        "mhtl_fullpct_efdt30d",
        "mbr_force_fullpct_efdt30d",
        "mbr_force_rmqty_pct",
        "mhtl_force_fullpct_efdt30d",
        "mhtl_force_rmqty_pct",
        "mbr_rmqty_occupied",
        "mhtl_rmqty_occupied",
        "cityi",
        "zonei",
        "zonestari",
        "defrecommend",
    ),
    scaled=(
        "mbr_ordnum_30d",
        "mbr_force_ordnum_30d",
        "mhtl_ordnum_30d",
        "mhtl_force_ordnum_30d",
        "mbr_ordnum_efdt30d",
        "mhtl_ordnum_efdt30d",
        "mbr_force_ordnum_efdt30d",
        "mhtl_force_ordnum_efdt30d",
        "close_hour_per",
    ),
    coded=("dayofweek", "star", "goldstar", "eid_source", "hotelbelongto"),
)
ALL_LEVELS = Columns(
    direct=(
        *(f"{level}_{kind}_{scope}" for level in LEVELS for kind in ("fullpct", "force_fullpct") for scope in SCOPES),
        *(f"{level}_{kind}" for level in LEVELS for kind in ("rmqty_occupied", "force_rmqty_pct")),
        "mhtl_holdpct",
        "cityi",
        "zonei",
        "zonestari",
        "defrecommend",
    ),
    scaled=(
        *(f"{level}_{kind}_{scope}" for level in LEVELS for kind in ("ordnum", "force_ordnum") for scope in SCOPES),
        "ordadvanceday",
        "rest_time",
    ),
    coded=("dayofweek", "star", "goldstar", "ord_hour", "ordadvanceday", "hotelbelongto"),
)
DUMMIES = Columns(
    direct=(
        "holidaydt",
        *(f"{level}_fullpct_{scope}" for scope in SCOPES for level in LEVELS),
        *(f"{level}_rmqty_occupied" for level in LEVELS),
        "cityi",
        "zonei",
        "zonestari",
        "rest_time",
        "mhtl_holdpct",
        *(f"{level}_ordnum_{scope}" for scope in SCOPES for level in LEVELS),
        "close_hour_per",
        "closetimes",
    ),
    coded=("star", "goldstar", "defrecommend", "isweekend", "ord_hour"),
    supplied=("timelag_last_close", "hpphtl_close_pct", "elongqunar_close_pct", "noshownum", "noshowratio"),
    supplied_coded=("capp",),
)
SUCCESS = Columns(
    direct=(
        "holidaydt",
        *(f"{level}_fullpct_{scope}" for scope in SCOPES for level in LEVELS),
        *(f"{level}_rmqty_occupied" for level in LEVELS),
        "cityi",
        "zonei",
        "zonestari",
        "rest_time",
        "mhtl_holdpct",
        *(f"{level}_force_fullpct_30d" for level in LEVELS),
        *(f"{level}_ordnum_{scope}" for scope in SCOPES for level in LEVELS),
        *(f"{level}_force_ordnum_30d" for level in LEVELS),
        "close_hour_per",
        "closetimes",
    ),
    coded=("star", "goldstar", "defrecommend", "isweekend"),
    supplied=("timelag_last_close", "hpphtl_close_pct", "elongqunar_close_pct", "success_pct", "noroom_ordnum"),
    supplied_coded=("capp",),
)


def with_derived(
    features: DataFrame,
    holidays: Sequence[tuple[date, date | None]] = HOLIDAYS_2016,
    holiday_of: str = "effectdate",
) -> DataFrame:
    """Columns that the matrices take from others; those that the features already have stay, but for the bounded code.

    Ratios over counts that only some callers supply come from those that are there. Recommendation codes outside of 1 to 9
    become 0.
    """
    c = F.col
    derived: Mapping[str, Column] = {
        "ord_hour": F.hour("order_ts"),
        "ordadvanceday": c("ordadvanceday2"),
        "isweekend": is_weekend(c("dayofweek")),
        "holidaydt": days_to_holiday(c(holiday_of), holidays),
        **caller_ratios(features.columns),
    }
    new = {name: column for name, column in derived.items() if name not in features.columns}
    return features.withColumns({**new, "defrecommend": bounded_code(c("defrecommend"))})


def training_matrix(
    features: DataFrame,
    columns: Columns,
    fit_on: Column,
    keep: Sequence[str] = ("orderid", "ordd"),
    categories: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Label, direct, standardised and 0/1 columns of each row.

    Means, deviations and categories come from the rows where ``fit_on`` holds, normally the training slice;
    ``categories`` can state those of a column instead. A category not seen there gives zeros. The
    needed columns are written once: fitting and encoding both read them.
    """
    columns = columns.given(features.columns)
    used = dict.fromkeys((*keep, *columns.direct, *columns.scaled, *columns.coded))
    wide = features.select(*used, accepted(F.col("isnoroom")).alias("isbookable"), fit_on.alias("_fit"))
    wide = stored(wide)
    fitting = wide.where("_fit")
    known = {**fit_categories(fitting, [c for c in columns.coded if c not in (categories or {})]), **(categories or {})}
    both = [c for c in columns.coded if c in columns.scaled or c in columns.direct]
    wide = wide.withColumns({f"_code_{c}": F.col(c) for c in both})
    wide = standardize(wide, fit_standardizer(fitting, columns.scaled)) if columns.scaled else wide
    for column in columns.coded:
        source = f"_code_{column}" if column in both else column
        wide = dummies(wide, source, known[column], prefix=column).drop(source)
    kept = [*keep, "isbookable", *columns.direct, *columns.scaled]
    return wide.select(*kept, *[c for c in wide.columns if c not in kept and c != "_fit"])
