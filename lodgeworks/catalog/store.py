"""Feature-store queries: point-in-time joins over events, services over the feature table."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from lodgeworks.catalog.cleaning import cleaned
from lodgeworks.catalog.features import _TABLE_SQL, feature_rows
from lodgeworks.catalog.registry import over_cleaned, query
from lodgeworks.operators import registry, store
from lodgeworks.operators.asof import FeatureSet, as_of_join, latest_by_key
from lodgeworks.operators.online import OnlineStore
from lodgeworks.session import fresh_path, staged
from lodgeworks.sources.bookings import table

WEEK = timedelta(days=7)


def _events(spark, sf, kind):
    return table(spark, sf, "events").filter(F.col("event_type") == kind)


def _spine(spark, sf):
    return _events(spark, sf, "purchase").select("event_id", "user_id", "ts")


def _views(spark, sf, kind="view", prefix="", ttl=WEEK):
    return FeatureSet(_events(spark, sf, kind).select("user_id", "ts", "value"), ("value",), "ts", ttl, prefix=prefix)


def _asof_sql(days: int = 7) -> str:
    return f"""SELECT s.event_id, s.user_id, s.ts,
      CASE WHEN f.ts >= s.ts - INTERVAL {days} DAY THEN f.value END AS value
      FROM (SELECT * FROM events WHERE event_type = 'purchase') s
      ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') f
      ON s.user_id = f.user_id AND s.ts >= f.ts"""


@query("j1_as_of_join", _asof_sql())
def as_of(spark, sf):
    return as_of_join(_spine(spark, sf), _views(spark, sf), ["user_id"], "ts")


@query("j1_as_of_join_heavy_keys", _asof_sql())
def as_of_heavy(spark, sf):
    """The same join with a row limit low enough that keys take the way for heavy ones."""
    return as_of_join(_spine(spark, sf), _views(spark, sf), ["user_id"], "ts", ranges=25)


@query("j1_as_of_join_one_day", _asof_sql(1))
def as_of_day(spark, sf):
    return as_of_join(_spine(spark, sf), _views(spark, sf, ttl=timedelta(days=1)), ["user_id"], "ts")


@query(
    "j2_as_of_join_two_views",
    """SELECT s.event_id, CASE WHEN v.ts >= s.ts - INTERVAL 7 DAY THEN v.value END AS view_value,
    CASE WHEN c.ts >= s.ts - INTERVAL 1 HOUR THEN c.value END AS click_value
    FROM (SELECT * FROM events WHERE event_type = 'purchase') s
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON s.user_id = v.user_id AND s.ts >= v.ts
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c ON s.user_id = c.user_id AND s.ts >= c.ts""",
)
def as_of_two(spark, sf):
    sets = [
        _views(spark, sf, "view", "view_"),
        _views(spark, sf, "click", "click_", timedelta(hours=1)),
    ]
    return as_of_join(_spine(spark, sf), sets, ["user_id"], "ts").select("event_id", "view_value", "click_value")


_LATEST_SQL = """SELECT user_id, ts, value FROM events WHERE event_type = 'view'
  QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1"""


@query(
    "j3_request_join",
    f"""SELECT r.event_id, r.user_id, r.value AS requested, l.value AS stored FROM
    (SELECT * FROM events WHERE event_type = 'click') r LEFT JOIN ({_LATEST_SQL}) l USING (user_id)""",
)
def request_join(spark, sf):
    requests = _events(spark, sf, "click").select("event_id", "user_id", F.col("value").alias("requested"))
    latest = latest_by_key(_events(spark, sf, "view").select("user_id", "ts", "value"), ["user_id"], "ts")
    return requests.join(latest.select("user_id", F.col("value").alias("stored")), "user_id", "left")


# --- services over the feature table -----------------------------------------------------------

_REQUESTS_SQL = """requests AS (SELECT booking_id, event_timestamp + INTERVAL (booking_id % 240) HOUR AS event_timestamp,
  lead_time AS lead_time_current, ROUND(avg_price_per_room::DOUBLE, 2)::FLOAT AS avg_price_per_room_current,
  no_of_special_requests AS no_of_special_requests_current, ((booking_id % 4) * 0.25)::FLOAT AS current_promotion_discount
  FROM t)"""


def _requests(rows):
    """One request per booking, up to ten days after its feature row."""
    hours = F.make_dt_interval(F.lit(0), (F.col("booking_id") % 240).cast("int"))
    return rows.select(
        "booking_id",
        (F.col("event_timestamp") + hours).alias("event_timestamp"),
        F.col("lead_time").alias("lead_time_current"),
        F.round(F.col("avg_price_per_room").cast("double"), 2).cast("float").alias("avg_price_per_room_current"),
        F.col("no_of_special_requests").alias("no_of_special_requests_current"),
        ((F.col("booking_id") % 4) * 0.25).cast("float").alias("current_promotion_discount"),
    )


def _service_sql(hours: int, prefix: str = "", own_time: bool = False) -> str:
    fresh = f"t.event_timestamp >= r.event_timestamp - INTERVAL {hours} HOUR"
    pick = lambda c: f"CASE WHEN {fresh} THEN t.{c} END"
    return over_cleaned(
        f"""SELECT r.booking_id, r.event_timestamp, {pick("lead_time")} AS lead_time,
        {pick("event_timestamp") + " AS hotel_booking_stats__event_timestamp," if own_time else ""} {pick("arrival_month")} AS arrival_month, {pick("arrival_date")} AS arrival_date,
        ROUND(({pick("avg_price_per_room")})::DOUBLE, 3) AS avg_price_per_room,
        {pick("no_of_special_requests")} AS no_of_special_requests,
        ROUND(({pick("avg_price_per_room")})::DOUBLE / (({pick("no_of_special_requests")}) + 0.001::DOUBLE), 3)
          AS {prefix}price_per_night_per_request,
        ROUND(r.avg_price_per_room_current::DOUBLE * (1 - r.current_promotion_discount::DOUBLE), 6)
          AS {prefix}discounted_price_per_room
        FROM requests r JOIN t USING (booking_id)""",
        f"t AS ({_TABLE_SQL})",
        _REQUESTS_SQL,
    )


def _served(spark, sf, name):
    rows = staged(feature_rows(spark, sf), "features")
    service = store.hotel_services()[name]
    view = service.views[0][0]
    prefix = "fresh_" if name.endswith("v3") else ""
    df = store.historical_features(service, _requests(rows), {view.name: rows})
    outs = {f"{prefix}price_per_night_per_request": 3, f"{prefix}discounted_price_per_room": 6}
    own_time = [c for c in df.columns if c.endswith("__event_timestamp")]
    return df.select(
        "booking_id", "event_timestamp", *own_time, "lead_time", "arrival_month", "arrival_date",
        F.round(F.col("avg_price_per_room").cast("double"), 3).alias("avg_price_per_room"),
        "no_of_special_requests", *[F.round(c, n).alias(c) for c, n in outs.items()],
    )


@query("p13_service_v1", _service_sql(7 * 24, own_time=True))
def service_v1(spark, sf):
    return _served(spark, sf, "hotel_prediction_v1")


@query("p13_service_v2", _service_sql(7 * 24))
def service_v2(spark, sf):
    return _served(spark, sf, "hotel_prediction_v2")


@query("p13_service_v3_fresh", _service_sql(1, "fresh_"))
def service_v3(spark, sf):
    return _served(spark, sf, "hotel_prediction_v3")


@query(
    "p14_training_service",
    over_cleaned(
        f"""SELECT booking_id, lead_time, arrival_month, arrival_date,
        ROUND(avg_price_per_room::DOUBLE, 3) AS avg_price_per_room, no_of_special_requests, booking_status
        FROM ({_TABLE_SQL})"""
    ),
)
def training_service(spark, sf):
    df = store.training_set(staged(feature_rows(spark, sf), "features"))
    return df.withColumn("avg_price_per_room", F.round(F.col("avg_price_per_room").cast("double"), 3))


@query(
    "f12_price_per_request",
    over_cleaned(
        """SELECT Booking_ID, ROUND(avg_price_per_room / (no_of_special_requests + 0.001::DOUBLE), 4)
        AS price_per_night_per_request FROM cleaned"""
    ),
)
def price_per_request(spark, sf):
    return cleaned(spark, sf).select(
        "Booking_ID", F.round(store.price_per_request(), 4).alias("price_per_night_per_request")
    )


@query(
    "f13_discounted_price",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    ROUND(l_extendedprice * (1 - l_discount), 4) AS discounted_price FROM lineitem""",
)
def discounted(spark, sf):
    price = store.discounted_price("l_extendedprice", "l_discount")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(price, 4).alias("discounted_price")
    )


@query(
    "f14_fresh_request_features",
    over_cleaned(
        """SELECT Booking_ID, ROUND(avg_price_per_room / (no_of_special_requests + 0.001::DOUBLE), 4)
        AS fresh_price_per_night_per_request, ROUND(avg_price_per_room * (1 - repeated_guest / 4.0::DOUBLE), 8)
        AS fresh_discounted_price_per_room FROM cleaned"""
    ),
)
def fresh_features(spark, sf):
    df = cleaned(spark, sf).withColumns(
        {
            "avg_price_per_room_current": F.col("avg_price_per_room"),
            "current_promotion_discount": F.col("repeated_guest") / 4.0,
        }
    )
    out = df.transform(store.request_time_features("fresh_"))
    digits = {"fresh_price_per_night_per_request": 4, "fresh_discounted_price_per_room": 8}
    return out.select("Booking_ID", *[F.round(c, n).alias(c) for c, n in digits.items()])


_SNAPSHOT_SQL = """SELECT user_id, ts, value FROM events WHERE event_type = 'view'
  AND ts <= TIMESTAMP '2024-01-20 00:00:00'
  QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1"""


@query("st2_snapshot", _SNAPSHOT_SQL)
def snapshot(spark, sf):
    rows = _events(spark, sf, "view").select("user_id", "ts", "value")
    return store.snapshot(rows, ["user_id"], "ts", end="2024-01-20 00:00:00")


@query("st2_incremental_materialization", _SNAPSHOT_SQL)
def incremental(spark, sf):
    """Two runs, the second starting where the first ended, give the snapshot of one."""
    root = fresh_path(spark, "materialized")
    source_path = f"{root}/source"
    _events(spark, sf, "view").select("user_id", "ts", "value").write.parquet(source_path)
    view = store.FeatureView(
        "event_values", store.Entity("user", ("user_id",)), ("value",), WEEK, store.TableSource(source_path, "ts")
    )
    first, second = "2024-01-10 00:00:00", "2024-01-20 00:00:00"
    store.materialize(spark, view, f"{root}/online", first)
    return store.materialize(spark, view, f"{root}/online", second, start=first, version=1)


@query("fs5_bucketed_materialization", _SNAPSHOT_SQL)
def bucketed(spark, sf):
    """Three runs into a store of buckets; each rewrites the buckets that it touches."""
    rows = staged(_events(spark, sf, "view").select("user_id", "ts", "value"), "views")
    stored = OnlineStore(spark, fresh_path(spark, "online"), ["user_id"], "ts")
    ends = ("2024-01-10 00:00:00", "2024-01-15 00:00:00", "2024-01-20 00:00:00")
    for start, end in zip((None, *ends), ends):
        stored.materialize(rows, end, start)
    return stored.read()


@query(
    "fs5_bucketed_lookup",
    f"""SELECT r.event_id, r.user_id, l.value AS stored FROM (SELECT * FROM events WHERE event_type = 'click' AND user_id % 97 = 5) r
    LEFT JOIN ({_SNAPSHOT_SQL}) l USING (user_id)""",
)
def bucketed_lookup(spark, sf):
    """Point reads of a few users: only their buckets are read."""
    rows = _events(spark, sf, "view").select("user_id", "ts", "value")
    stored = OnlineStore(spark, fresh_path(spark, "online"), ["user_id"], "ts")
    stored.materialize(rows, "2024-01-20 00:00:00")
    asked = _events(spark, sf, "click").filter("user_id % 97 = 5").select("event_id", "user_id")
    return stored.lookup(asked, ["value"]).withColumnRenamed("value", "stored")


@query(
    "fs5_registry_apply",
    over_cleaned(f"SELECT booking_id, lead_time, booking_status FROM ({_TABLE_SQL})"),
)
def registry_apply(spark, sf):
    """Definitions are applied to a registry; the training service, loaded by name, reads the feature table."""
    root = fresh_path(spark, "registry")
    feature_rows(spark, sf).write.parquet(f"{root}/rows")
    services = store.hotel_services(store.hotel_views(store.TableSource(f"{root}/rows", "event_timestamp")))
    known = registry.Registry(spark, f"{root}/definitions")
    known.apply(services.values())
    service = known.service("training")
    rows = service.views[0][0].table.read(spark)
    found = store.historical_features(service, rows.select("booking_id", "event_timestamp"))
    return found.select("booking_id", "lead_time", "booking_status")


@query(
    "s14_serving_log",
    over_cleaned(f"SELECT COUNT(*) * 2 AS n_logged, COUNT(DISTINCT booking_id) AS n_bookings FROM ({_TABLE_SQL})"),
)
def serving_log(spark, sf):
    path = fresh_path(spark, "feature-log")
    rows = staged(feature_rows(spark, sf), "features")
    service = store.hotel_services()["hotel_prediction_v1"]
    served = store.historical_features(service, rows.select("booking_id", "event_timestamp"), {"hotel_booking_stats": rows})
    for _ in range(2):
        store.log_served(served, path)
    return spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("n_logged"), F.countDistinct("booking_id").alias("n_bookings")
    )


@query(
    "fs2_online_features",
    over_cleaned(
        f"""SELECT booking_id, lead_time AS lead_time_current, lead_time AS stored_lead_time
        FROM ({_TABLE_SQL})"""
    ),
)
def online(spark, sf):
    rows = staged(feature_rows(spark, sf), "features")
    latest = latest_by_key(rows, ["booking_id"], "event_timestamp")
    out = store.online_features(
        store.hotel_services()["hotel_prediction_v1"], _requests(rows).drop("event_timestamp"), latest,
        as_of="2024-02-02 00:00:00",
    )
    return out.select("booking_id", "lead_time_current", F.col("lead_time").alias("stored_lead_time"))


@query(
    "fs2_online_two_views",
    """SELECT s.user_id, v.value AS viewed, p.value AS bought FROM (SELECT DISTINCT user_id FROM events) s
    LEFT JOIN (SELECT user_id, value FROM events WHERE event_type = 'view'
      QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1) v USING (user_id)
    LEFT JOIN (SELECT user_id, ts, value FROM events WHERE event_type = 'purchase'
      QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1) p
      ON p.user_id = s.user_id AND p.ts >= TIMESTAMP '2024-01-28 00:00:00'""",
)
def online_two_views(spark, sf):
    """A service over two views, the second of which keeps its rows for two days only."""
    user = store.Entity("user", ("user_id",))
    views, latest = [], {}
    for kind, name, ttl in (("view", "viewed", timedelta(days=60)), ("purchase", "bought", timedelta(days=2))):
        rows = _events(spark, sf, kind).select("user_id", F.col("ts").alias("event_timestamp"), F.col("value").alias(name))
        latest[name] = latest_by_key(rows, ["user_id"], "event_timestamp")
        views.append((store.FeatureView(name, user, (name,), ttl), (name,)))
    requests = table(spark, sf, "events").select("user_id").distinct()
    return store.online_features(store.FeatureService("both", tuple(views)), requests, latest, as_of="2024-01-30 00:00:00")


@query(
    "x4_custom_transform",
    _asof_sql().replace("SELECT s.event_id, s.user_id, s.ts,", "SELECT event_id, ROUND(value * 2 + 1, 6) AS doubled FROM (SELECT s.event_id, s.user_id, s.ts,") + ")",
)
def custom_transform(spark, sf):
    """A user's frame-to-frame function as the request-time step of a service."""
    view = store.FeatureView("event_values", store.Entity("user", ("user_id",)), ("value",), WEEK)
    service = store.FeatureService(
        "mine", ((view, ("value",)),), (lambda df: df.withColumn("doubled", F.col("value") * 2 + 1),)
    )
    rows = _events(spark, sf, "view").select("user_id", F.col("ts").alias("event_timestamp"), "value")
    spine = _spine(spark, sf).withColumnRenamed("ts", "event_timestamp")
    return store.historical_features(service, spine, {"event_values": rows}).select(
        "event_id", F.round("doubled", 6).alias("doubled"))
