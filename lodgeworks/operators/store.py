"""Feature views, services, request-time features and materialization over parquet tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import timedelta
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeworks.operators.asof import FeatureSet, as_of_join, latest_by_key
from lodgeworks.session import staged

Transform = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Entity:
    name: str
    keys: tuple[str, ...]


@dataclass(frozen=True)
class TableSource:
    """A parquet table with an event time and, if it has one, a creation time."""

    path: str
    timestamp: str
    created: str | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


@dataclass(frozen=True)
class PushSource:
    """Rows that arrive as a stream in front of a batch table."""

    name: str
    batch: TableSource


@dataclass(frozen=True)
class FeatureView:
    name: str
    entity: Entity
    fields: tuple[str, ...]
    ttl: timedelta
    source: TableSource | PushSource | None = None

    @property
    def table(self) -> TableSource | None:
        return self.source.batch if isinstance(self.source, PushSource) else self.source

    def feature_set(self, rows: DataFrame, fields: Sequence[str] | None = None, prefix: str = "") -> FeatureSet:
        created = self.table.created if self.table else None
        return FeatureSet(
            rows,
            tuple(fields or self.fields),
            self.table.timestamp if self.table else "event_timestamp",
            self.ttl,
            created if created in rows.columns else None,
            prefix,
        )


@dataclass(frozen=True)
class FeatureService:
    """A selection of view fields plus request-time transforms over them."""

    name: str
    views: tuple[tuple[FeatureView, tuple[str, ...]], ...]
    on_demand: tuple[Transform, ...] = ()
    log_path: str | None = None
    request_fields: tuple[str, ...] = ()


def price_per_request(price: str = "avg_price_per_room", requests: str = "no_of_special_requests") -> Column:
    return F.col(price).cast("double") / (F.col(requests) + F.lit(0.001).cast("double"))


def discounted_price(price: str = "avg_price_per_room_current", discount: str = "current_promotion_discount") -> Column:
    return F.col(price).cast("double") * (1 - F.col(discount).cast("double"))


@cache
def request_time_features(prefix: str = "") -> Transform:
    """The two request-time prices, with a name prefix for the fresh variant; one function per prefix."""

    def transform(df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                f"{prefix}price_per_night_per_request": price_per_request(),
                f"{prefix}discounted_price_per_room": discounted_price(),
            }
        )

    return transform


# View, service and field names that clients of the store use.
STATS_FIELDS = ("lead_time", "arrival_month", "arrival_date", "avg_price_per_room", "no_of_special_requests")
REQUEST_FIELDS = ("lead_time_current", "avg_price_per_room_current",
                  "no_of_special_requests_current", "current_promotion_discount")
BOOKING = Entity("booking", ("booking_id",))


def hotel_views(source: TableSource | None = None) -> dict[str, FeatureView]:
    """The booking statistics view (7 days), its fresh twin (1 hour) and the training view."""
    push = PushSource("hotel_stats_push_source", source) if source else None
    return {
        "hotel_booking_stats": FeatureView(
            "hotel_booking_stats", BOOKING, STATS_FIELDS, timedelta(days=7), source,
        ),
        "hotel_booking_stats_fresh": FeatureView(
            "hotel_booking_stats_fresh", BOOKING, STATS_FIELDS, timedelta(hours=1), push,
        ),
        "hotel_features": FeatureView(
            "hotel_features", BOOKING, (*STATS_FIELDS, "booking_status", "booking_date"),
            timedelta(days=7), source,
        ),
    }


def hotel_services(views: dict[str, FeatureView] | None = None) -> dict[str, FeatureService]:
    """Services v1 to v3 and the training service, the one that can give the target."""
    v = views or hotel_views()
    stats, fresh, training = (v[n] for n in ("hotel_booking_stats", "hotel_booking_stats_fresh", "hotel_features"))
    now, now_fresh = request_time_features(), request_time_features("fresh_")
    return {
        "hotel_prediction_v1": FeatureService(
            "hotel_prediction_v1", ((stats, ("event_timestamp", *STATS_FIELDS)),), (now,), "data/feature_logs", REQUEST_FIELDS
        ),
        "hotel_prediction_v2": FeatureService(
            "hotel_prediction_v2", ((stats, stats.fields),), (now,), request_fields=REQUEST_FIELDS
        ),
        "hotel_prediction_v3": FeatureService(
            "hotel_prediction_v3", ((fresh, fresh.fields),), (now_fresh,), request_fields=REQUEST_FIELDS
        ),
        "training": FeatureService("training", ((training, training.fields),)),
    }


def historical_features(
    service: FeatureService,
    spine: DataFrame,
    rows: dict[str, DataFrame] | None = None,
    ts: str = "event_timestamp",
) -> DataFrame:
    """Point-in-time features of a service for a spine of (keys, ``ts``).

    All views of the service are joined in one pass over the keys. ``rows`` gives the feature rows
    per view name; views that are not listed are read from their source. A field that the spine has too (as
    the time of the feature row) is named ``{view}__{field}``. Request-time transforms
    run when the spine carries the request columns the service names.
    """
    rows = rows or {}
    sets = []
    for view, fields in service.views:
        table = rows.get(view.name)
        if table is None:
            if view.table is None:
                raise ValueError(f"view {view.name} has no source and no rows were given")
            table = view.table.read(spine.sparkSession)
        sets.append(view.feature_set(table, fields))
    keys = service.views[0][0].entity.keys
    sets = [replace(s, names=tuple(f"{v.name}__{f}" if f in spine.columns else f for f in s.fields))
            for (v, _), s in zip(service.views, sets)]
    joined = as_of_join(spine, sets, keys, ts)
    if set(service.request_fields) <= set(joined.columns):
        for transform in service.on_demand:
            joined = joined.transform(transform)
    return joined


def online_features(
    service: FeatureService, requests: DataFrame, latest: DataFrame | dict[str, DataFrame], as_of: str | None = None,
    on_demand: bool = True,
) -> DataFrame:
    """Requests joined with the latest feature row of their key in every view, then request-time transforms.

    ``latest`` gives the latest rows per view name, or those of the only view. With ``as_of`` a row older
    than its view's TTL reads as null. Requests without the request columns that the service names
    raise ValueError unless ``on_demand`` is off. A field that several views have comes from the first.
    """
    given = latest if isinstance(latest, dict) else {service.views[0][0].name: latest}
    if missing := [v.name for v, _ in service.views if v.name not in given]:
        raise ValueError(f"no latest rows for the views {missing}")
    if on_demand and (absent := sorted(set(service.request_fields) - set(requests.columns))):
        raise ValueError(f"the requests lack {absent}")
    joined = requests
    for view, fields in service.views:
        ts = view.table.timestamp if view.table else "event_timestamp"
        chosen = [f for f in fields if f not in joined.columns]
        stored = given[view.name].select(
            *view.entity.keys, F.col(ts).alias("_at"), *[F.col(f).alias(f"_v_{f}") for f in chosen])
        joined = joined.join(stored, list(view.entity.keys), "left")
        kept = F.lit(True)
        if as_of is not None:
            kept = F.col("_at") >= F.lit(as_of).cast("timestamp_ntz") - F.expr(
                f"INTERVAL '{int(view.ttl.total_seconds())}' SECOND"
            )
        joined = joined.withColumns({f: F.when(kept, F.col(f"_v_{f}")) for f in chosen}).drop(
            "_at", *[f"_v_{f}" for f in chosen])
    for transform in service.on_demand if on_demand else ():
        joined = joined.transform(transform)
    return joined


def log_served(df: DataFrame, path: str) -> None:
    """Append served features to the log table."""
    df.write.mode("append").parquet(path)


def snapshot(
    rows: DataFrame, keys: Sequence[str], ts: str, end: str, start: str | None = None,
    previous: DataFrame | None = None,
) -> DataFrame:
    """Newest row per key with ``start < ts <= end``, merged over the previous snapshot.

    The time filter reaches the scan. The previous snapshot has one row per key, so merging it is
    one more input of the same aggregation.
    """
    stamp = F.col(ts)
    window = rows.filter(stamp <= F.lit(end).cast("timestamp_ntz"))
    if start is not None:
        window = window.filter(stamp > F.lit(start).cast("timestamp_ntz"))
    if previous is not None:
        window = window.unionByName(previous)
    return latest_by_key(window, keys, ts)


def materialize(
    spark: SparkSession, view: FeatureView, out_dir: str, end: str, start: str | None = None,
    version: int = 0,
) -> DataFrame:
    """Write the snapshot as version ``version``; the version before it is the starting point."""
    source = view.table
    columns = [*view.entity.keys, source.timestamp, *[f for f in view.fields if f != source.timestamp]]
    rows = source.read(spark).select(*columns)
    previous = spark.read.parquet(f"{out_dir}/version={version - 1}") if version else None
    path = f"{out_dir}/version={version}"
    snapshot(rows, view.entity.keys, source.timestamp, end, start, previous).write.mode(
        "overwrite"
    ).parquet(path)
    return spark.read.parquet(path)


def training_set(
    features: DataFrame, service: FeatureService | None = None, target: str = "booking_status",
    fallback: DataFrame | None = None,
) -> DataFrame:
    """Point-in-time training rows, key kept, times and dates dropped.

    The spine is the key and time of the feature table itself. An empty result raises unless a
    ``fallback`` frame is given; nothing falls back silently.
    """
    service = service or hotel_services()["training"]
    view = service.views[0][0]
    spine = features.select(*view.entity.keys, "event_timestamp")
    joined = staged(historical_features(service, spine, {view.name: features}), "training")
    # The spine's own times and keys are never null; only the features can tell whether anything matched.
    found = [c for c in joined.columns if c not in (*view.entity.keys, "event_timestamp")]
    if joined.filter(F.coalesce(*[F.col(c).cast("string") for c in found]).isNotNull()).isEmpty():
        if fallback is None:
            raise ValueError("no feature rows matched the spine")
        joined = fallback
    if target not in joined.columns:
        raise ValueError(f"the service gives no {target}")
    return joined.drop("event_timestamp", "booking_date")
