"""Registered queries: every operator over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightledger.functions import calendar, codes, ratios
from nightledger.operators import (
    batches,
    capacity,
    carried,
    enrich,
    evaluate,
    lookback,
    model,
    periods,
    prep,
    prepared,
    quality,
    status,
    stay,
    sweep,
)
from nightledger.plans import matrix
from nightledger.plans.features import assemble, bucketed_blocks, feature_blocks, feature_table, lookback_blocks
from nightledger.session import cut_lineage, shared_path
from nightledger.sources import adapters as src
from nightledger.sources import files, tables

Query = Callable[[SparkSession, str], DataFrame]

# The test bookings run from 1995 to 2001, so dated parameters are moved there.
SINCE = date(1995, 3, 1)
HOLIDAYS = (
    (date(1996, 4, 2), date(1996, 4, 4)),
    (date(1996, 4, 30), date(1996, 5, 2)),
    (date(1996, 6, 9), None),
)
PERIODS = {
    name: (low.replace(year=1996), high.replace(year=1996)) for name, (low, high) in periods.HOLD_PERIODS_2016.items()
}
SPLIT = {
    "train": (date(1996, 1, 1), date(1999, 1, 1)),
    "validation": (date(1999, 1, 1), date(2000, 1, 1)),
    "test": (date(2000, 1, 1), date(2000, 12, 31)),
}
# Changes of one instant are ordered by their id.
TIE = ("event_id",)
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def _nights(spark: SparkSession, folder: str) -> DataFrame:
    return stay.stay_split(src.bookings(spark, folder))


def _targets(spark: SparkSession, folder: str) -> DataFrame:
    return stay.select_targets(_nights(spark, folder), SINCE)


def orders_enriched(spark: SparkSession, folder: str) -> DataFrame:
    picked = enrich.select_bookings(
        src.booking_snapshot(spark, folder), date(1995, 1, 1), date(2001, 6, 1), date(2001, 6, 3)
    )
    hotels = src.hotel_dim(spark, folder)
    return enrich.enrich_orders(
        picked,
        src.raw_rooms(spark, folder),
        hotels,
        src.raw_base_rooms(spark, folder),
        src.shadow_orders(spark, folder),
        src.cancels(spark, folder),
        date(2016, 5, 16),
        date(2016, 6, 1),
    )


def modal_category(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.mode_per_key(src.bookings(spark, folder), "room", "balancetype")


def modal_correction(spark: SparkSession, folder: str) -> DataFrame:
    corrected = enrich.correct_to_mode(src.bookings(spark, folder), "room", "balancetype")
    return corrected.select("orderid", "room", "balancetype")


def stay_nights(spark: SparkSession, folder: str) -> DataFrame:
    return _nights(spark, folder).select("orderid", "effectdate", "room", "ordroomnum", "ord_days")


def rest_time(spark: SparkSession, folder: str) -> DataFrame:
    return stay.with_rest_time(src.bookings(spark, folder)).select(
        "orderid", "order_ts", "checkindate", "deadline", "rest_time"
    )


def target_selection(spark: SparkSession, folder: str) -> DataFrame:
    return _targets(spark, folder).select("orderid", "effectdate", "ordd", "order_ts", "hotel")


def base_features(spark: SparkSession, folder: str) -> DataFrame:
    wide = stay.base_features(_targets(spark, folder), src.hotel_dim(spark, folder), src.room_dim(spark, folder))
    return wide.select(
        "orderid",
        "effectdate",
        "dayofweek",
        "ordadvanceday2",
        "city",
        "zone",
        "star",
        "cprflag",
        "goldstar",
        "mhtl_roomquantity",
        "defrecommend",
    )


def _lookback(level: str, scope: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        earlier = _nights(spark, folder) if scope == "efdt" else src.bookings(spark, folder)
        return lookback.entity_lookback(_targets(spark, folder), earlier, level, scope)

    return query


def hold_orders(spark: SparkSession, folder: str) -> DataFrame:
    return lookback.hold_orders(_targets(spark, folder), src.bookings(spark, folder))


def _capacity(level: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return capacity.max_capacity(_targets(spark, folder), _nights(spark, folder), level)

    return query


def status_rank(spark: SparkSession, folder: str) -> DataFrame:
    return status.status_rank(src.status_log(spark, folder), TIE).select(
        "event_id", "room", "effectdate", "operatetime", "rn"
    )


def status_backfill(spark: SparkSession, folder: str) -> DataFrame:
    return status.status_backfill(src.status_log(spark, folder), tie=TIE)


def status_backfill_windows(spark: SparkSession, folder: str) -> DataFrame:
    return status.status_backfill(src.status_log(spark, folder), days=2, tie=TIE, known_days=1)


def status_backfill_as_written(spark: SparkSession, folder: str) -> DataFrame:
    return status.repeated(_as_written(spark, folder))


def _as_written(spark: SparkSession, folder: str) -> DataFrame:
    return status.status_backfill(src.status_log(spark, folder), tie=TIE, as_written=True)


def close_transitions(spark: SparkSession, folder: str) -> DataFrame:
    return status.close_transitions(status_backfill(spark, folder))


def close_counts(spark: SparkSession, folder: str) -> DataFrame:
    return status.close_counts(close_transitions(spark, folder))


def close_counts_as_written(spark: SparkSession, folder: str) -> DataFrame:
    return status.close_counts(status.close_transitions(_as_written(spark, folder)))


def order_status_history(spark: SparkSession, folder: str) -> DataFrame:
    return status.order_status_history(src.order_probes(spark, folder), close_transitions(spark, folder))


def shared_status_history(spark: SparkSession, folder: str) -> DataFrame:
    return status.shared_status_history(src.order_probes(spark, folder), close_transitions(spark, folder))


def close_hours(spark: SparkSession, folder: str) -> DataFrame:
    hours = status.close_hours(src.order_probes(spark, folder), close_transitions(spark, folder))
    return hours.withColumn("closehours", F.round("closehours", 6))


def latest_close_event(spark: SparkSession, folder: str) -> DataFrame:
    found = status.latest_close_event(src.order_probes(spark, folder), src.status_log(spark, folder), TIE)
    return found.select(
        "orderid", "room", "effectdate", "operatetime", "old_roomstatus", "new_roomstatus", "eid_source"
    )


def batch_asof(spark: SparkSession, folder: str) -> DataFrame:
    return batches.batch_asof(
        src.order_probes(spark, folder), src.batch_index(spark, folder), ["city", "zone"], ["cityi"]
    )


def batch_asof_any_hour(spark: SparkSession, folder: str) -> DataFrame:
    return batches.batch_asof(
        src.order_probes(spark, folder), src.hourly_index(spark, folder), ["city", "zone"], ["cityi"]
    )


def _features(spark: SparkSession, folder: str, orders: DataFrame | None = None, make=feature_table, **options):
    return make(
        src.bookings(spark, folder) if orders is None else orders,
        src.hotel_dim(spark, folder),
        src.room_dim(spark, folder),
        src.stay_status_log(spark, folder),
        src.stay_batch_index(spark, folder),
        SINCE,
        status_tie=TIE,
        **options,
    )


def booking_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshot, enrichment, usual payment type, nights and the whole feature row in one run."""
    orders = enrich.correct_to_mode(orders_enriched(spark, folder), "room", "balancetype")
    wide = _features(spark, folder, orders, check=True, close_features=True)
    hours = {c: F.round(c, 6).alias(c) for c in ("rest_time", "closehours", "close_hour_per")}
    more = ["balancetype", "isnoroom", "ord_hour", "closetimes", "closehours", "close_hour_per"]
    return wide.select(*[hours.get(c, F.col(c)) for c in (*FEATURE_COLUMNS, *more)])


FEATURE_COLUMNS = (
    "orderid",
    "effectdate",
    "dayofweek",
    "ordadvanceday2",
    "mhtl_roomquantity",
    "rest_time",
    *(f"{level}_{m}_30d" for level in ratios.LEVELS for m in lookback.DAILY_MEASURES),
    *(f"{level}_{m}_efdt30d" for level in ratios.LEVELS for m in lookback.EFDT_MEASURES),
    *(f"{level}_max_rmqty" for level in ratios.LEVELS),
    "mhtl_hold_ordnum",
    "eid_source",
    "cityi",
    "zonei",
    "zonestari",
)


def feature_assembly(spark: SparkSession, folder: str) -> DataFrame:
    return _features(spark, folder).select(*FEATURE_COLUMNS).withColumn("rest_time", F.round("rest_time", 6))


def feature_assembly_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The same from blocks that lie in buckets of the order id."""
    path = shared_path(spark)
    base, blocks = bucketed_blocks(*_features(spark, folder, make=feature_blocks), path, 8, f"features_{path.rpartition('/')[2]}")
    wide = assemble(base, *blocks.values())
    return wide.select(*FEATURE_COLUMNS).withColumn("rest_time", F.round("rest_time", 6))


# Where one run over the bookings ends and the next begins.
RUNS = (date(1998, 1, 1),)


def carried_features(spark: SparkSession, folder: str) -> DataFrame:
    """Look-back counts and capacity of all targets, made in two runs, of which each reads its own orders and kept totals."""
    orders, path = src.bookings(spark, folder), shared_path(spark)
    carried.keep(orders.limit(0), path, files=1)
    runs = []
    for first, after in zip((SINCE.replace(year=1990), *RUNS), (*RUNS, None), strict=True):
        kept = carried.kept_before(orders, path, first)
        new = carried.new_orders(orders, first)
        new = new if after is None else new.where(F.col("order_ts") < F.lit(after))
        targets = cut_lineage(stay.select_targets(stay.stay_split(new), max(first, SINCE)))
        runs.append(assemble(targets.select("orderid"), *lookback_blocks(targets, new, kept)))
        if after:
            carried.keep(new, path, files=1)
    wide = reduce(DataFrame.unionByName, runs)
    return wide.select(*[c for c in FEATURE_COLUMNS if c in wide.columns])


def ratio_features(spark: SparkSession, folder: str) -> DataFrame:
    wide = ratios.with_ratios(_features(spark, folder), rule="zero_or_9999")
    return wide.select("orderid", *[F.round(c, 9).alias(c) for c in ratios.ratio_catalogue()])


def _supplied(wide: DataFrame) -> DataFrame:
    """Counts that a caller adds to the feature row."""
    k = F.col("orderid")
    return wide.withColumns(
        {
            "timelag_last_close": k % 48,
            "close_roomcnt_hpp": k % 4,
            "close_roomcnt_htl": k % 3,
            "room_cnt_hpp": k % 5,
            "room_cnt_htl": k % 2,
            "close_roomcnt_elongqunar": k % 3,
            "room_cnt_elongqunar": k % 7,
            "noshownum": F.when(k % 5 > 0, k % 3),
            "roomefdtnum": k % 6,
            "success_pct": (k % 100) / 100,
            "noroom_ordnum": k % 9,
            "capp": (k % 3).cast("int"),
        }
    )


def _matrix(columns: matrix.Columns, supplied: bool = False) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        wide = ratios.with_ratios(_features(spark, folder, close_features=True), rule="zero_or_9999")
        wide = _supplied(wide) if supplied else wide
        wide = matrix.with_derived(wide, HOLIDAYS)
        low, high = SPLIT["train"]
        slice_ = (F.col("ordd") >= F.lit(low)) & (F.col("ordd") < F.lit(high))
        codes_kept = {"defrecommend": range(10)} if "defrecommend" in columns.coded else None
        rows = matrix.training_matrix(wide, columns, slice_, keep=("orderid",), categories=codes_kept)
        return rows.select(*[F.round(c, 6).alias(c) if kind == "double" else F.col(c) for c, kind in rows.dtypes])

    return query


def hold_daily(spark: SparkSession, folder: str) -> DataFrame:
    return periods.hold_daily(_nights(spark, folder))


def hold_ratio_by_period(spark: SparkSession, folder: str) -> DataFrame:
    return periods.hold_ratio_by_period(hold_daily(spark, folder), PERIODS)


def _hotel_days(spark: SparkSession, folder: str) -> DataFrame:
    """Rooms ordered and rooms sold per hotel and day next to the hotel's room quantity."""
    sold = F.when(F.col("isnoroom") == 0, F.col("ordroomnum")).otherwise(0)
    days = src.bookings(spark, folder).groupBy("hotel", "ordd").agg(
        F.sum("ordroomnum").alias("ordered"), F.sum(sold).alias("sold")
    )
    return days.join(src.hotel_dim(spark, folder).select("hotel", "roomquantity"), "hotel").withColumn(
        "top", F.when(F.col("ordered") % 4 != 0, F.col("ordered"))
    )


def capacity_imputation(spark: SparkSession, folder: str) -> DataFrame:
    days = _hotel_days(spark, folder)
    filled = {
        rule: ratios.imputed_capacity(F.col("roomquantity"), F.col("top"), rule).cast("long")
        for rule in ratios.CAPACITY_RULES
    }
    return days.select("hotel", "ordd", *[column.alias(rule) for rule, column in filled.items()])


def capped_occupancy(spark: SparkSession, folder: str) -> DataFrame:
    days = _hotel_days(spark, folder)
    sold, quantity = F.col("sold"), F.col("roomquantity")
    return days.select(
        "hotel",
        "ordd",
        ratios.safe_ratio(sold, quantity).alias("plain"),
        ratios.capped_ratio(sold, quantity).alias("capped"),
        ratios.powered(sold).alias("squared"),
        ratios.reciprocal(sold).alias("inverse"),
        ratios.pooled_share(["sold"], ["sold", "ordered"]).alias("pooled"),
        ratios.safe_ratio(ratios.filled(F.col("top")), ratios.zero_as_missing(quantity)).alias("top_share"),
        codes.bounded_code(quantity).alias("bounded"),
    )


def calendar_features(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("checkindate")
    weekday = calendar.weekday_number(day)
    return src.bookings(spark, folder).select(
        "orderid",
        weekday.alias("dayofweek"),
        calendar.is_weekend(weekday).alias("isweekend"),
        calendar.lead_days(day, F.col("order_ts")).alias("lead_days"),
        calendar.days_to_holiday(day, HOLIDAYS).alias("holidaydt"),
        ratios.accepted(F.col("isnoroom")).alias("isbookable"),
    )


def _numbers(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    return src.table(spark, folder, "orders").select(
        key.alias("orderid"),
        F.to_date("o_orderdate").alias("ordd"),
        F.col("o_totalprice").alias("price"),
        F.nullif((key % 5).cast("double"), F.lit(0.0)).alias("steps"),
        F.lit(1.0).alias("level"),
    )


def standardize(spark: SparkSession, folder: str) -> DataFrame:
    rows = _numbers(spark, folder)
    columns = ["price", "steps", "level"]
    scaled = prep.standardize(rows, prep.fit_standardizer(rows, columns))
    return scaled.select("orderid", *[F.round(c, 6).alias(c) for c in columns])


def saved_preparation(spark: SparkSession, folder: str) -> DataFrame:
    """What a preparation that was fitted, saved and read again makes of the rows."""
    status = src.table(spark, folder, "orders").select(F.col("o_orderkey").alias("orderid"), F.col("o_orderstatus").alias("status"))
    rows = _numbers(spark, folder).join(status, "orderid")
    numbers = ["price", "steps", "level"]
    path = shared_path(spark)
    prepared.save_prepared(prepared.preparation(scaled=numbers, categories=["status"]).fit(rows), path)
    made = prepared.load_prepared(path).transform(rows).withColumn("x", vector_to_array("features"))
    return made.select("orderid", *[F.round(F.col("x")[i], 6).alias(c) for i, c in enumerate([*numbers, "f", "o", "p"])])


def label_encode(spark: SparkSession, folder: str) -> DataFrame:
    events = src.table(spark, folder, "events").select("event_id", "event_type")
    return prep.label_encode(events, prep.fit_label_encoder(events, "event_type"))


def one_hot(spark: SparkSession, folder: str) -> DataFrame:
    coded = prep.one_hot(label_encode(spark, folder), ["event_type_code"])
    slots = F.transform(vector_to_array("event_type_code_vec"), lambda v: v.cast("int").cast("string"))
    return coded.select("event_id", F.concat_ws(",", slots).alias("slots"))


def dummies(spark: SparkSession, folder: str) -> DataFrame:
    events = src.table(spark, folder, "events").select("event_id", "event_type")
    return prep.dummies(events, "event_type", EVENT_TYPES, prefix="kind").drop("event_type")


def temporal_split(spark: SparkSession, folder: str) -> DataFrame:
    rows = src.bookings(spark, folder).select("orderid", "ordd", (1 - F.col("isnoroom")).alias("isbookable"))
    return prep.with_slice(rows, SPLIT, closed=("test",))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.round(c, 9).alias(c) if kind == "double" and c != "threshold" else F.col(c) for c, kind in df.dtypes]
    )


def _evaluation(step: Callable[..., DataFrame], **options) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return _rounded(step(src.scored(spark, folder), **options))

    return query


def _run_evaluation(step: Callable[..., DataFrame], **options) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return _rounded(step(src.scored_runs(spark, folder), by=["run"], **options))

    return query


MODEL_COLUMNS = (
    "ordroomnum",
    "dayofweek",
    "rest_time",
    "mhtl_roomquantity",
    "htl_ordnum_30d",
    "htl_full_ordnum_30d",
    "htl_force_ordnum_30d",
)


def _model_rows(spark: SparkSession, folder: str) -> DataFrame:
    targets = _targets(spark, folder)
    base = stay.base_features(targets, src.hotel_dim(spark, folder), src.room_dim(spark, folder))
    counts = lookback.entity_lookback(targets, src.bookings(spark, folder), "htl", "all")
    return base.join(counts, "orderid", "left").select(
        "orderid",
        "ordd",
        ratios.accepted(F.col("isnoroom")).alias("isbookable"),
        "ordroomnum",
        "dayofweek",
        calendar.rest_hours(F.col("order_ts"), F.col("checkindate")).alias("rest_time"),
        "mhtl_roomquantity",
        "htl_ordnum_30d",
        "htl_full_ordnum_30d",
        "htl_force_ordnum_30d",
    )


def _sliced(rows: DataFrame) -> DataFrame:
    return prep.with_slice(rows, SPLIT, closed=("test",))


def gbt_score(spark: SparkSession, folder: str) -> DataFrame:
    rows = cut_lineage(_sliced(_model_rows(spark, folder)))
    known = rows.where("slice in ('train', 'validation')")
    fitted = model.train_gbt(known, MODEL_COLUMNS, held_out=F.col("slice") == "validation")
    return model.score(fitted, rows.where("slice = 'test'"), MODEL_COLUMNS, keep=["orderid", "isbookable"])


def grid_search(spark: SparkSession, folder: str) -> DataFrame:
    grid = sweep.grid_frame(
        spark, {"depth": (3, 4, 5, 6), "colsample": (0.8,), "subsample": (0.8,), "learning_rate": (0.1,)}
    )
    return sweep.grid_search(_sliced(_model_rows(spark, folder)), MODEL_COLUMNS, grid)


# One tree of depth 1 on a 0/1 column, without sampling, has a closed form.
STUMP = {"maxIter": 1, "maxDepth": 1, "subsamplingRate": 1.0, "minInstancesPerNode": 1}


def _stump_rows(spark: SparkSession, folder: str) -> DataFrame:
    forced = codes.flag(F.col("isforceorder") == "T").alias("forced")
    return _sliced(
        src.bookings(spark, folder).select("orderid", "ordd", ratios.accepted(F.col("isnoroom")).alias("isbookable"), forced)
    )


def gbt_stump_score(spark: SparkSession, folder: str) -> DataFrame:
    rows = _stump_rows(spark, folder)
    fitted = model.train_gbt(rows.where("slice = 'train'"), ["forced"], params=STUMP)
    scored = model.score(fitted, rows.where("slice = 'test'"), ["forced"], keep=["orderid", "isbookable"])
    return scored.withColumn("score", F.round("score", 9))


def gbt_staged_losses(spark: SparkSession, folder: str) -> DataFrame:
    """Loss of the validation slice after each of 12 rounds, and the rounds that a patience of 3 keeps."""
    rows = _stump_rows(spark, folder)
    fitted = model.train_gbt(rows.where("slice = 'train'"), ["forced"], params=STUMP | {"maxIter": 12})
    curve = model.staged_losses(fitted, rows.where("slice = 'validation'"), ["forced"])
    best, _ = model.best_prefix([r["loss"] for r in curve.orderBy("round").collect()], 3)
    return curve.select("round", F.round("loss", 9).alias("loss"), (F.col("round") <= best).alias("kept"))


def gbt_patience(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of the test slice by the rounds that a patience of 3 keeps."""
    rows = _stump_rows(spark, folder)
    known = rows.where("slice in ('train', 'validation')")
    fitted = model.train_gbt(
        known, ["forced"], params=STUMP | {"maxIter": 12}, held_out=F.col("slice") == "validation", patience=3
    )
    scored = model.score(fitted, rows.where("slice = 'test'"), ["forced"], keep=["orderid", "isbookable"])
    return scored.withColumn("score", F.round("score", 9))


def grid_search_axes(spark: SparkSession, folder: str) -> DataFrame:
    """Several values on three axes; on one 0/1 column only the data decide, so each run has the recall of the closed form."""
    grid = sweep.grid_frame(
        spark, {"depth": (1, 2), "colsample": (0.5, 1.0), "subsample": (1.0,), "learning_rate": (0.1, 0.2)}
    )
    found = sweep.grid_search(
        _stump_rows(spark, folder), ["forced"], grid, floor=0.4, parallelism=4, params={"maxIter": 1, "minInstancesPerNode": 1}
    )
    return found.withColumn("recall", F.round("recall", 9))


def grid_search_stump(spark: SparkSession, folder: str) -> DataFrame:
    grid = sweep.grid_frame(
        spark, {"depth": (1,), "colsample": (1.0,), "subsample": (1.0,), "learning_rate": (0.1, 0.2)}
    )
    found = sweep.grid_search(
        _stump_rows(spark, folder), ["forced"], grid, floor=0.4, params={"maxIter": 1, "minInstancesPerNode": 1}
    )
    return found.withColumn("recall", F.round("recall", 9))


def grid_remaining(spark: SparkSession, folder: str) -> DataFrame:
    return sweep.remaining(sweep.grid_frame(spark, sweep.GRIDS["all_depths"]), src.grid_log(spark, folder))


def _best_by(parameter: str) -> Query:
    return lambda spark, folder: sweep.best_by(src.grid_log(spark, folder), parameter)


def grid_best_runs(spark: SparkSession, folder: str) -> DataFrame:
    return sweep.best_runs(src.grid_log(spark, folder), 10)


def grid_values(spark: SparkSession, folder: str) -> DataFrame:
    return sweep.parameter_values(src.grid_log(spark, folder), "learning_rate", descending=True)


def recall_surface(spark: SparkSession, folder: str) -> DataFrame:
    return sweep.recall_surface(src.grid_log(spark, folder), 6, 0.04)


def null_rates(spark: SparkSession, folder: str) -> DataFrame:
    rows = orders_enriched(spark, folder).select("masterbasicroomid", "hotel", "shadow_type", "canceltime")
    return quality.null_rates(rows).withColumn("null_rate", F.round("null_rate", 9))


def refreshed_days(spark: SparkSession, folder: str) -> DataFrame:
    """A table by month, two of its months written anew, read for the months of some targets."""
    month = F.trunc("ordd", "month").alias("d")
    rows = src.bookings(spark, folder).select("orderid", "ordroomnum", month).where("d < date '1997-01-01'")
    path = shared_path(spark)
    tables.refresh_days(rows, path)
    anew = rows.where("d in (date '1996-03-01', date '1996-04-01') and orderid % 2 = 0")
    tables.refresh_days(anew.withColumn("ordroomnum", F.col("ordroomnum") + 100), path)
    wanted = _targets(spark, folder).where("ordd < date '1996-06-01'").select(F.trunc("ordd", "month"))
    return tables.of_days(tables.read_table(spark, path), wanted).groupBy("d").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("ordroomnum").alias("rooms")
    )


def status_days(spark: SparkSession, folder: str) -> DataFrame:
    """Status changes of a range of days, from a log partitioned by day."""
    path = shared_path(spark)
    log = src.status_log(spark, folder).withColumn("d", F.to_date("operatetime"))
    tables.refresh_days(log, path, files=1)
    ranged = tables.scan_range(tables.read_table(spark, path), date(2024, 1, 5), date(2024, 1, 20), closed=True)
    return ranged.groupBy("d").agg(F.count(F.lit(1)).alias("changes"), F.count("new_roomstatus").alias("known"))


def batch_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Batches of a range of days within hours."""
    index = src.hourly_index(spark, folder)
    return tables.scan_batches(index, date(2024, 1, 5), date(2024, 1, 20), first_hour=6, last_hour=20)


FEATURE_FILE = "orderid bigint, price double, ordd date, kind string"


def feature_file(spark: SparkSession, folder: str) -> DataFrame:
    """Features written as tab-separated text, with missing values, and read again."""
    k, path = F.col("o_orderkey"), shared_path(spark)
    made = src.table(spark, folder, "orders").select(
        k.alias("orderid"),
        F.when(k % 4 > 0, F.col("o_totalprice")).alias("price"),
        F.to_date("o_orderdate").alias("ordd"),
        F.when(k % 3 > 0, F.col("o_orderpriority")).alias("kind"),
    )
    files.write_features(made, path)
    return files.read_features(spark, path, FEATURE_FILE)


def grid_log_file(spark: SparkSession, folder: str) -> DataFrame:
    """A sweep log appended to twice, as text without a header."""
    log, path = src.grid_log(spark, folder), shared_path(spark)
    for part in (log.where("depth < 5"), log.where("depth >= 5")):
        files.append_grid_log(part, path)
    return files.read_grid_log(spark, path)


def matrix_export(spark: SparkSession, folder: str) -> DataFrame:
    """A slice without its day and label, exported with a header and read again."""
    rows = _sliced(_stump_rows(spark, folder).withColumn("forced", F.col("forced").cast("int")))
    path = shared_path(spark)
    files.write_csv(prep.drop_columns(rows.where("slice = 'train'"), "ordd", "isbookable", "slice"), path)
    return spark.read.schema("orderid bigint, forced int").option("header", True).csv(path)


def observed_save(spark: SparkSession, folder: str) -> DataFrame:
    """What was counted while the bookings were written."""
    tests = {"force_orders": F.col("isforceorder") == "T", "recent": F.col("order_ts") >= F.lit(SINCE)}
    counts, shares = tables.save_observed(src.bookings(spark, folder), shared_path(spark), tests, ["balancetype", "isforceorder"])
    rows = [(k, float(v)) for k, v in counts.items()] + [(f"null {k}", round(v, 9)) for k, v in shares.items()]
    return spark.createDataFrame(rows, "measure string, value double")


def column_profile(spark: SparkSession, folder: str) -> DataFrame:
    orders = src.table(spark, folder, "orders")
    return quality.profile(orders.select(*[c for c, kind in orders.dtypes if kind in ("string", "int", "bigint")]))


def checked_features(spark: SparkSession, folder: str) -> DataFrame:
    """Clean rows and lines set aside of a feature file with missing keys and dates that are none."""
    k, path = F.col("o_orderkey"), shared_path(spark)
    day = F.when(k % 7 == 0, F.lit("2016-13-45")).otherwise(F.to_date("o_orderdate").cast("string"))
    made = src.table(spark, folder, "orders").select(F.when(k % 5 > 0, k).alias("orderid"), F.col("o_totalprice").alias("price"), day.alias("ordd"))
    files.write_features(made, path)
    clean, bad = files.read_checked(spark, path, "orderid bigint, price double, ordd date", keys=["orderid"])
    return clean.agg(F.lit("clean").alias("kind"), F.count(F.lit(1)).alias("n"), F.sum("orderid").alias("key_sum")).unionByName(
        bad.agg(F.lit("aside").alias("kind"), F.count(F.lit(1)).alias("n"), F.lit(None).cast("long").alias("key_sum"))
    )


def distinct_violations(spark: SparkSession, folder: str) -> DataFrame:
    return quality.distinct_violations(src.bookings(spark, folder), "room", "balancetype")


def distinct_values(spark: SparkSession, folder: str) -> DataFrame:
    return quality.distinct_values(src.bookings(spark, folder), "balancetype")


def value_histogram(spark: SparkSession, folder: str) -> DataFrame:
    rows = stay.with_rest_time(src.bookings(spark, folder))
    return quality.value_histogram(rows.select(F.floor("rest_time").alias("rest_hours")), "rest_hours")


def quality_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_counts(
        src.bookings(spark, folder),
        {
            "force_orders": F.col("isforceorder") == "T",
            "empty_stays": F.col("etd") <= F.col("checkindate"),
            "recent": F.col("order_ts") >= F.lit(SINCE),
        },
    )


def registered() -> dict[str, Query]:
    by_level = {}
    for level in ratios.LEVELS:
        by_level[f"lookback_{level}_efdt"] = _lookback(level, "efdt")
        by_level[f"lookback_{level}_30d"] = _lookback(level, "all")
        by_level[f"capacity_{level}"] = _capacity(level)
    return {
        "orders_enriched": orders_enriched,
        "modal_category": modal_category,
        "modal_correction": modal_correction,
        "stay_split": stay_nights,
        "rest_time": rest_time,
        "target_selection": target_selection,
        "base_features": base_features,
        **by_level,
        "hold_orders": hold_orders,
        "status_rank": status_rank,
        "status_backfill": status_backfill,
        "status_backfill_windows": status_backfill_windows,
        "status_backfill_as_written": status_backfill_as_written,
        "close_transitions": close_transitions,
        "close_counts": close_counts,
        "close_counts_as_written": close_counts_as_written,
        "close_hours": close_hours,
        "order_status_history": order_status_history,
        "shared_status_history": shared_status_history,
        "latest_close_event": latest_close_event,
        "batch_asof": batch_asof,
        "batch_asof_any_hour": batch_asof_any_hour,
        "feature_assembly": feature_assembly,
        "feature_assembly_bucketed": feature_assembly_bucketed,
        "carried_features": carried_features,
        "ratio_features": ratio_features,
        "booking_pipeline": booking_pipeline,
        "training_matrix": _matrix(matrix.ALL_LEVELS),
        "training_matrix_standardised": _matrix(matrix.STANDARDISED),
        "training_matrix_dummies": _matrix(matrix.DUMMIES),
        "training_matrix_no_show": _matrix(matrix.DUMMIES, supplied=True),
        "training_matrix_success": _matrix(matrix.SUCCESS, supplied=True),
        "hold_daily": hold_daily,
        "hold_ratio_by_period": hold_ratio_by_period,
        "capacity_imputation": capacity_imputation,
        "capped_occupancy": capped_occupancy,
        "calendar_features": calendar_features,
        "standardize": standardize,
        "saved_preparation": saved_preparation,
        "label_encode": label_encode,
        "one_hot": one_hot,
        "dummies": dummies,
        "temporal_split": temporal_split,
        "pr_curve": _evaluation(evaluate.pr_curve),
        "recall_at_precision": _evaluation(evaluate.recall_at_precision, floor=0.7),
        "pr_curve_by_run": _run_evaluation(evaluate.pr_curve),
        "recall_by_run": _run_evaluation(evaluate.recall_at_precision, floor=0.7),
        "pr_table": _evaluation(evaluate.pr_table),
        "confusion": _evaluation(evaluate.confusion),
        "class_report": _evaluation(evaluate.class_report),
        "roc_curve": _evaluation(evaluate.roc_curve),
        "roc_auc": _evaluation(evaluate.roc_auc),
        "roc_auc_hard": _evaluation(evaluate.roc_auc, hard=True),
        "f1_like": _evaluation(evaluate.f1_like),
        "gbt_score": gbt_score,
        "gbt_stump_score": gbt_stump_score,
        "gbt_staged_losses": gbt_staged_losses,
        "gbt_patience": gbt_patience,
        "grid_search": grid_search,
        "grid_search_axes": grid_search_axes,
        "grid_search_stump": grid_search_stump,
        "grid_remaining": grid_remaining,
        "grid_best_by_depth": _best_by("depth"),
        "grid_best_by_learning_rate": _best_by("learning_rate"),
        "grid_best_runs": grid_best_runs,
        "grid_values": grid_values,
        "recall_surface": recall_surface,
        "null_rates": null_rates,
        "refreshed_days": refreshed_days,
        "status_days": status_days,
        "batch_hours": batch_hours,
        "feature_file": feature_file,
        "grid_log_file": grid_log_file,
        "matrix_export": matrix_export,
        "observed_save": observed_save,
        "column_profile": column_profile,
        "checked_features": checked_features,
        "distinct_violations": distinct_violations,
        "distinct_values": distinct_values,
        "value_histogram": value_histogram,
        "quality_counts": quality_counts,
    }
