"""The same results as ``queries.py`` in DuckDB SQL over the test tables."""

from __future__ import annotations

from footfall.adapter import (
    DEVICE_CYCLE, LOCATIONS, PAGES, QUERIES as SEARCH_TERMS, TYPE_NAMES, USER_AGENTS,
)
from footfall.operators.quality import OTHER
from footfall.operators.temporal import DAY_PARTS
from footfall.plans.queries import (
    APART, CENTROID_COLUMNS, CENTROIDS, CHOSEN_SEGMENTS, DAY, EXPERIMENT, GAP_SECONDS, RANGE,
)
from footfall.schema import (
    DETAIL_METRICS, DEVICES, EVENT_COLUMNS, EVENT_TYPES, FEATURE_COLUMNS, RADAR_METRICS,
    TIMESTAMP_RANGE,
)

GAP_MICROS = GAP_SECONDS * 1_000_000


def sql_list(values) -> str:
    return "[" + ", ".join(f"'{value}'" for value in values) + "]"


def in_list(values) -> str:
    return "(" + ", ".join(f"'{value}'" for value in values) + ")"


def pick(values, position: str) -> str:
    return f"({sql_list(values)})[{position} % {len(values)} + 1]"


WEB_EVENTS = f"""
web_events AS (
  SELECT event_id,
    'user_' || user_id AS user_id,
    'session_' || user_id || '_' || strftime(ts, '%Y%m%d') AS session_id,
    ts AS "timestamp",
    CASE event_type {" ".join(f"WHEN '{a}' THEN '{b}'" for a, b in TYPE_NAMES.items())}
      ELSE event_type END AS event_type,
    {pick(PAGES, "k")} AS page,
    {pick(USER_AGENTS, "k")} AS user_agent,
    {pick(LOCATIONS, "user_id")} AS location,
    {pick(DEVICE_CYCLE, "event_id")} AS device_type,
    CASE WHEN event_type = 'signup' THEN {pick(SEARCH_TERMS, "k")} END AS search_query,
    CASE WHEN event_type = 'error' THEN 'prod_' || (k + 1) END AS product_id,
    CASE WHEN event_type = 'error' THEN k % 7 END AS quantity,
    CASE WHEN event_type = 'purchase' THEN 'order_' || event_id END AS order_id,
    CASE WHEN event_type = 'purchase' THEN value END AS total_amount
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events) e
)"""


def stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def day_text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def event_columns(*columns: str) -> str:
    return ", ".join(f'{stamp(c)} AS "{c}"' if c == "timestamp" else c for c in columns)


RAW = event_columns(*EVENT_COLUMNS)

DEVICE_COUNTS = ", ".join(
    f"count(*) FILTER (WHERE device_type = '{device}') AS {device}" for device in DEVICES
)

FEATURE_AGGREGATES = f"""
    count(*) AS total_events,
    count(search_query) AS total_searches,
    count(*) FILTER (WHERE event_type = 'add_to_cart') AS total_cart_adds,
    count(*) FILTER (WHERE event_type = 'purchase') AS total_purchases,
    avg(total_amount) AS avg_purchase_amount,
    count(DISTINCT session_id) AS total_sessions,
    count(DISTINCT page) AS unique_pages_visited,
    {DEVICE_COUNTS}"""


def features_where(condition: str) -> str:
    return f"""
features AS (
  SELECT user_id, {FEATURE_AGGREGATES}
  FROM web_events WHERE user_id IS NOT NULL AND {condition}
  GROUP BY user_id
)"""


def whole_days(first: str, last: str) -> str:
    return f"""
    "timestamp" >= TIMESTAMP '{first}' AND "timestamp" < TIMESTAMP '{last}' + INTERVAL 1 DAY"""


def rounded(columns) -> str:
    return ", ".join(
        f"round({c}, 6) AS {c}" if c == "avg_purchase_amount" else c for c in columns
    )


FEATURE_ROW = "user_id, " + rounded(FEATURE_COLUMNS)


def squared_distance(centroid) -> str:
    deltas = [
        f"(coalesce({name}, 0)::DOUBLE - {float(c)}::DOUBLE)"
        for name, c in zip(CENTROID_COLUMNS, centroid)
    ]
    return " + ".join(f"{delta} * {delta}" for delta in deltas)


# Smallest (distance, index) pair: the lowest index wins a tie.
PROFILE = f"""
profile AS (
  SELECT *, list_min([{", ".join(
      f"{{'d': {squared_distance(c)}, 'i': {i}}}" for i, c in enumerate(CENTROIDS)
  )}]).i::INTEGER AS segment
  FROM (SELECT * REPLACE (round(avg_purchase_amount, 6) AS avg_purchase_amount) FROM features)
)"""

ALL_FEATURES = f"{WEB_EVENTS}, {features_where('true')}"
ALL_PROFILE = f"{ALL_FEATURES}, {PROFILE}"


def with_events(body: str) -> str:
    return f"WITH {WEB_EVENTS} {body}"


def within_range(body: str) -> str:
    """``web_events`` are those of the range's days only."""
    every = WEB_EVENTS.replace("web_events AS", "every_event AS")
    return f"WITH {every}, web_events AS (SELECT * FROM every_event WHERE {whole_days(*RANGE)}) {body}"


def with_features(body: str) -> str:
    return f"WITH {ALL_FEATURES} {body}"


def with_profile(body: str) -> str:
    return f"WITH {ALL_PROFILE} {body}"


def means(columns) -> str:
    return ", ".join(f"avg({c}) AS {c}" for c in columns)


def rounded_means(columns) -> str:
    return ", ".join(f"round(avg({c}), 6) AS {c}" for c in columns)


def per_user(aggregates: str) -> str:
    return with_events(f"SELECT user_id, {aggregates} FROM web_events GROUP BY user_id")


# Rule name -> condition under which an event breaks it, in output order.
RULES = {
    "user_missing": "user_id IS NULL",
    "session_missing": "session_id IS NULL",
    "timestamp_missing": '"timestamp" IS NULL',
    "event_type_unknown": f"NOT coalesce(event_type IN {in_list(EVENT_TYPES)}, false)",
    "device_unknown": f"NOT coalesce(device_type IN {in_list(DEVICES)}, false)",
    "search_without_query": "coalesce(event_type = 'search', false) AND search_query IS NULL",
    "cart_without_product": "coalesce(event_type = 'add_to_cart', false) AND product_id IS NULL",
    "cart_quantity_out_of_range":
        "coalesce(event_type = 'add_to_cart', false)"
        " AND NOT coalesce(quantity BETWEEN 1 AND 5, false)",
    "purchase_without_order": "coalesce(event_type = 'purchase', false) AND order_id IS NULL",
    "purchase_amount_not_positive":
        "coalesce(event_type = 'purchase', false) AND NOT coalesce(total_amount > 0, false)",
    "timestamp_implausible":
        f"""coalesce("timestamp" < TIMESTAMP '{TIMESTAMP_RANGE[0]}'"""
        f""" OR "timestamp" >= TIMESTAMP '{TIMESTAMP_RANGE[1]}', false)""",
    "amount_not_finite": "coalesce(NOT isfinite(total_amount), false)",
}
FAILED = "concat_ws(',', " + ", ".join(
    f"CASE WHEN {broken} THEN '{name}' END" for name, broken in RULES.items()
) + ")"
ANY_FAILED = " OR ".join(f"({broken})" for broken in RULES.values())

DAY_PART_COUNTS = ", ".join(
    f"""count(*) FILTER (WHERE hour("timestamp") BETWEEN {a} AND {b}) AS {part}"""
    for part, (a, b) in DAY_PARTS.items()
)

SESSIONS = """
sessions AS (
  SELECT user_id, session_id, min("timestamp") AS first_at, max("timestamp") AS last_at,
    epoch_us(max("timestamp")) - epoch_us(min("timestamp")) AS span, count(*) AS events
  FROM web_events WHERE session_id IS NOT NULL
  GROUP BY user_id, session_id
)"""

DURATIONS = f"""
durations AS (
  SELECT user_id, count(*) AS sessions,
    CAST(sum(span) AS BIGINT) / count(*) / 1e6::DOUBLE AS mean_duration_s,
    max(span) / 1e6::DOUBLE AS max_duration_s
  FROM sessions GROUP BY user_id
)"""

FREQUENCY = """
frequency AS (
  SELECT user_id,
    count("timestamp") / count(DISTINCT CAST("timestamp" AS DATE)) AS events_per_active_day,
    CASE WHEN count("timestamp") > 1 THEN
      (epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) / (count("timestamp") - 1) / 1e6::DOUBLE
    END AS mean_gap_s
  FROM web_events GROUP BY user_id
)"""

GAP_SESSIONS = f"""
marked AS (
  SELECT user_id, "timestamp", event_id,
    CASE WHEN epoch_us("timestamp") - epoch_us(lag("timestamp") OVER w) <= {GAP_MICROS}
      THEN 0 ELSE 1 END AS starts
  FROM web_events WINDOW w AS (PARTITION BY user_id ORDER BY "timestamp", event_id)
),
numbered AS (
  SELECT *, CAST(sum(starts) OVER (PARTITION BY user_id ORDER BY "timestamp", event_id) AS BIGINT)
    AS session_number
  FROM marked
),
gap_sessions AS (
  SELECT user_id, session_number, min("timestamp") AS first_at, max("timestamp") AS last_at,
    count(*) AS events
  FROM numbered GROUP BY user_id, session_number
)"""

GAP_SESSION_ROW = f"""
  {stamp("first_at")} AS session_start, {stamp("last_at")} AS session_end,
  (epoch_us(last_at) - epoch_us(first_at)) / 1e6::DOUBLE AS duration_s, events"""

DAILY_FEATURES = f"""
daily AS (
  SELECT CAST("timestamp" AS DATE) AS day, user_id, {FEATURE_AGGREGATES}
  FROM web_events GROUP BY ALL
)"""

# What the watermark has closed once all events are read.
WATERMARK = """(SELECT max("timestamp") - INTERVAL 1 HOUR FROM web_events)"""


def dot(left: str, right: str) -> str:
    return " + ".join(f"{left}{i} * {right}{i}" for i in range(len(FEATURE_COLUMNS)))


def slots(template: str) -> str:
    return ", ".join(template.format(i=i, c=c) for i, c in enumerate(FEATURE_COLUMNS))


SILHOUETTE = with_profile(f""",
points AS (
  SELECT user_id, segment, {slots("CAST(coalesce({c}, 0) AS DOUBLE) AS x{i}")} FROM profile
),
normed AS (SELECT *, {dot("x", "x")} AS xi FROM points),
clusters AS (
  SELECT segment, CAST(count(*) AS DOUBLE) AS n, sum(xi) AS psi, {slots("sum(x{i}) AS y{i}")}
  FROM normed GROUP BY segment
),
distances AS (
  SELECT p.user_id, p.segment AS own, c.segment AS other, c.n,
    p.xi + c.psi / c.n - 2 * ({dot("p.x", "c.y")}) / c.n AS d
  FROM normed p CROSS JOIN clusters c
),
scores AS (
  SELECT user_id, max(n) FILTER (WHERE own = other) AS n,
    max(d * n / nullif(n - 1, 0)) FILTER (WHERE own = other) AS a,
    min(d) FILTER (WHERE own <> other) AS b
  FROM distances GROUP BY user_id
)
SELECT round(avg(CASE WHEN n = 1 OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 9)
  AS silhouette
FROM scores""")


def recommendation(n: int, item: str, made_of: str | None = None) -> str:
    return with_profile(f""",
touched AS (
  SELECT user_id, {made_of or item} AS {item}, count(*) AS times FROM web_events
  WHERE {made_of or item} IS NOT NULL GROUP BY ALL
),
popular AS (
  SELECT segment, {item}, CAST(sum(times) AS BIGINT) AS segment_events
  FROM touched JOIN profile USING (user_id) GROUP BY segment, {item}
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY segment ORDER BY segment_events DESC, {item})
    AS INTEGER) AS segment_rank
  FROM popular QUALIFY segment_rank <= {n}
)
SELECT p.user_id, p.segment, r.{item}, r.segment_rank, r.segment_events
FROM profile p JOIN ranked r USING (segment)
WHERE NOT EXISTS (
  SELECT 1 FROM touched t WHERE t.user_id = p.user_id AND t.{item} = r.{item}
)""")


def headline(users: str) -> str:
    """KPIs with their display text."""
    return f""",
headline AS (
  SELECT count(*) AS total_users, avg(avg_purchase_amount) AS avg_purchase_value,
    avg(CASE WHEN total_purchases > 0 THEN 1.0::DOUBLE ELSE 0.0 END) * 100 AS conversion_rate
  FROM {users}
)
SELECT total_users, round(avg_purchase_value, 6) AS avg_purchase_value,
  round(conversion_rate, 6) AS conversion_rate,
  printf('$%.2f', avg_purchase_value) AS avg_purchase_value_text,
  printf('%.1f%%', conversion_rate) AS conversion_rate_text
FROM headline"""


def share(name: str, condition: str) -> str:
    return f"round(avg(CASE WHEN {condition} THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS {name}"


def per_day(aggregates: str) -> str:
    return with_events(
        f"""SELECT {day_text('"timestamp"')} AS day, count(*) AS events, {aggregates}
        FROM web_events GROUP BY 1"""
    )


DAILY_ZSCORE = with_events(f""",
days AS (
  SELECT CAST(unnest(generate_series(min("timestamp")::DATE, max("timestamp")::DATE, INTERVAL 1 DAY))
    AS DATE) AS day
  FROM web_events
),
types AS (SELECT unnest({sql_list([*EVENT_TYPES, OTHER])}) AS event_type),
counts AS (
  SELECT CAST("timestamp" AS DATE) AS day,
    CASE WHEN event_type IN {in_list(EVENT_TYPES)} THEN event_type ELSE '{OTHER}' END AS event_type,
    count(*) AS events
  FROM web_events GROUP BY ALL
),
filled AS (
  SELECT day, event_type, coalesce(events, 0) AS events
  FROM (FROM days CROSS JOIN types) LEFT JOIN counts USING (day, event_type)
),
past AS (
  SELECT *, count(*) OVER w AS n, avg(events) OVER w AS m, stddev_samp(events) OVER w AS s
  FROM filled
  WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
)
SELECT {day_text("day")} AS day, event_type, events,
  CASE WHEN n = 7 THEN round(m, 6) END AS mean_before,
  CASE WHEN n = 7 THEN round(s, 6) END AS std_before,
  CASE WHEN n = 7 AND s > 0 THEN round((events - m) / s, 6) END AS z_score
FROM past""")

ALL_DEVICES = " + ".join(DEVICES)

AB_COUNTS = """
counts AS (
  SELECT count(*) FILTER (WHERE variant = 'A') AS users_a,
    count(*) FILTER (WHERE variant = 'A' AND converted) AS converters_a,
    count(*) FILTER (WHERE variant = 'B') AS users_b,
    count(*) FILTER (WHERE variant = 'B' AND converted) AS converters_b
  FROM groups
),
rates AS (
  SELECT *, converters_a / nullif(users_a, 0) AS rate_a, converters_b / nullif(users_b, 0) AS rate_b,
    (converters_a + converters_b) / nullif(users_a + users_b, 0) AS p
  FROM counts
)
SELECT users_a, converters_a, users_b, converters_b,
  round(rate_a, 6) AS rate_a, round(rate_b, 6) AS rate_b,
  round(rate_b / nullif(rate_a, 0) - 1, 6) AS lift,
  round((rate_b - rate_a)
    / nullif(sqrt(p * (1 - p) * (1.0::DOUBLE / users_a + 1.0::DOUBLE / users_b)), 0), 6) AS z_score
FROM rates"""


def ab_test(users: str, converted: str) -> str:
    """Variant by the first digit of a digest, then the comparison."""
    return f""",
groups AS (
  SELECT CASE WHEN contains('02468ace', substr(md5(user_id || '|{EXPERIMENT}'), 1, 1)) THEN 'A' ELSE 'B' END
    AS variant, {converted} AS converted
  FROM {users}
),{AB_COUNTS}"""


# Of each seven events five are written with something wrong; see the query.
REJECTED_LINES = with_events(f""",
written AS (
  SELECT event_id % 7 AS m, * REPLACE (
    CASE WHEN event_id % 7 <> 3 THEN user_id END AS user_id,
    CASE event_id % 7 WHEN 2 THEN NULL WHEN 5 THEN TIMESTAMP '2999-01-01' ELSE "timestamp" END AS "timestamp",
    CASE WHEN event_id % 7 = 4 THEN 'nan'::DOUBLE ELSE total_amount END AS total_amount
  )
  FROM web_events
),
read AS (
  SELECT m, {", ".join(f'CASE WHEN m <> 1 THEN "{c}" END AS "{c}"' for c in EVENT_COLUMNS)} FROM written
)
SELECT concat_ws(',', {", ".join(f"CASE WHEN {broken} THEN '{name}' END" for name, broken in RULES.items())},
  CASE WHEN m IN (1, 2) THEN 'unparseable' END) AS failed_rules, count(*) AS lines
FROM read GROUP BY 1""")

UNDECLARED = {
    "experiment": ("event_id % 3 = 0", "string"), "scroll": ("event_id % 4 = 0", "number"),
    "geo": ("event_id % 5 = 0", "object"), "tags": ("event_id % 6 = 0", "array"),
}
FIELDS = {
    **{c: (f'"{c}" IS NOT NULL', "number" if c in ("quantity", "total_amount") else "string") for c in EVENT_COLUMNS},
    **UNDECLARED,
}
FIELD_PRESENCE = with_events(" " + " UNION ALL ".join(
    f"""SELECT '{name}' AS field, {str(name not in UNDECLARED).lower()} AS declared,
      count(*) FILTER (WHERE {there} AND event_id % 50 <> 7) AS lines,
      count(*) FILTER (WHERE {there} AND event_id % 50 <> 7) / count(*) AS share,
      '{kind}' AS types
    FROM web_events"""
    for name, (there, kind) in FIELDS.items()
))

ORACLES: dict[str, str] = {
    "scan_json": with_events(f"SELECT {RAW} FROM web_events"),
    "event_to_json": with_events(f"SELECT {RAW} FROM web_events"),
    "roundtrip_features": with_features(f"SELECT {FEATURE_ROW} FROM features"),
    "transform_job": (
        f"WITH {WEB_EVENTS}, {features_where(whole_days(*RANGE))} SELECT {FEATURE_ROW} FROM features"
    ),
    "transform_landed_job": (
        f"WITH {WEB_EVENTS}, {features_where(f'{whole_days(*RANGE)} AND NOT ({ANY_FAILED})')} "
        f"SELECT {FEATURE_ROW} FROM features"
    ),
    "transform_inputs": (
        f"WITH {WEB_EVENTS}, {features_where(whole_days(*RANGE))} SELECT {FEATURE_ROW}, input "
        "FROM features, (VALUES ('json'), ('landed')) i(input)"
    ),
    "rejected_lines": REJECTED_LINES,
    "undeclared_fields": FIELD_PRESENCE,
    "undeclared_by_value": with_events(
        """ SELECT CASE WHEN event_id % 3 = 0 AND event_id % 50 <> 7 THEN 'variant ' || event_id % 2 END AS experiment,
          count(*) AS lines, count(DISTINCT CASE WHEN event_id % 50 <> 7 THEN user_id END) AS users,
          count(*) FILTER (WHERE event_type = 'purchase' AND event_id % 50 <> 7) AS purchases,
          CAST(sum(CASE WHEN event_id % 5 = 0 AND event_id % 50 <> 7 THEN event_id % 90 END) AS BIGINT) AS latitudes
        FROM web_events GROUP BY 1"""
    ),
    "land_events": with_events(
        f"""SELECT {RAW}, {FAILED} AS failed_rules,
          CASE WHEN {ANY_FAILED} THEN 'rejected' ELSE 'valid' END AS verdict,
          {day_text('"timestamp"')} AS event_date
        FROM web_events"""
    ),
    "compacted_days": with_events(
        f""" SELECT {day_text('"timestamp"')} AS event_date,
          CASE WHEN {ANY_FAILED} THEN 'rejected' ELSE 'valid' END AS verdict, count(*) AS events,
          count(DISTINCT user_id) AS users, CAST(sum(quantity) AS BIGINT) AS quantity, {stamp('min("timestamp")')} AS first_at
        FROM web_events GROUP BY ALL"""
    ),
    "validate_events": with_events(
        f"SELECT event_id, {FAILED} AS failed_rules, NOT ({ANY_FAILED}) AS valid FROM web_events"
    ),
    "sql_top_spenders": with_features(
        """SELECT user_id, total_purchases,
          round(avg_purchase_amount * total_purchases, 2) AS total_spend
        FROM features ORDER BY total_spend DESC, user_id LIMIT 10"""
    ),
    "filter_range_closed": with_events(
        f"""SELECT event_id, {RAW} FROM web_events
        WHERE "timestamp" BETWEEN TIMESTAMP '{RANGE[0]}' AND TIMESTAMP '{RANGE[1]}'"""
    ),
    "filter_range_daily": with_events(
        f"SELECT event_id, {RAW} FROM web_events WHERE {whole_days(DAY, DAY)}"
    ),
    "segment_map": with_profile("SELECT user_id, segment FROM profile"),
    "segment_filter": with_profile(
        f"SELECT {FEATURE_ROW}, segment FROM profile WHERE segment IN "
        f"({', '.join(map(str, CHOSEN_SEGMENTS))})"
    ),
    "segment_options": with_profile("SELECT DISTINCT segment FROM profile ORDER BY segment"),
    "features_join": with_features(f"SELECT {FEATURE_ROW} FROM features"),
    "profile_join": with_profile(f"SELECT {FEATURE_ROW}, segment FROM profile"),
    "user_totals": with_features(
        f"SELECT user_id, {', '.join(FEATURE_COLUMNS[:4])} FROM features"
    ),
    "user_avg_purchase": with_features(
        "SELECT user_id, round(avg_purchase_amount, 6) AS avg_purchase_amount FROM features"
    ),
    "user_distincts": with_features(
        "SELECT user_id, total_sessions, unique_pages_visited FROM features"
    ),
    "device_counts": with_events(
        'SELECT user_id, device_type, count(*) AS "count" FROM web_events GROUP BY ALL'
    ),
    "device_pivot": per_user(DEVICE_COUNTS),
    "user_features": with_features(f"SELECT {FEATURE_ROW} FROM features"),
    "user_features_day": (
        f"WITH {WEB_EVENTS}, {features_where(whole_days(DAY, DAY))} SELECT {FEATURE_ROW} FROM features"
    ),
    "daily_features": with_events(
        f", {DAILY_FEATURES} SELECT {day_text('day')} AS day, {FEATURE_ROW} FROM daily"
    ),
    "segment_sizes": with_profile(
        'SELECT segment, count(*) AS "count" FROM profile GROUP BY segment ORDER BY segment'
    ),
    "segment_profile": with_profile(
        f"SELECT segment, {rounded_means(FEATURE_COLUMNS)} FROM profile GROUP BY segment"
    ),
    "segment_counts_desc": with_profile(
        """SELECT segment, count(*) AS "count" FROM profile
        GROUP BY segment ORDER BY "count" DESC, segment"""
    ),
    "segment_radar": with_profile(f""",
m AS (SELECT segment, {means(RADAR_METRICS)} FROM profile GROUP BY segment),
long AS (UNPIVOT m ON {", ".join(RADAR_METRICS)} INTO NAME metric VALUE mean_value),
bounds AS (
  SELECT *, min(mean_value) OVER (PARTITION BY metric) AS low,
    max(mean_value) OVER (PARTITION BY metric) AS high
  FROM long
)
SELECT segment, metric, round(mean_value, 6) AS mean_value,
  round((mean_value - low) / nullif(high - low, 0), 6) AS scaled
FROM bounds"""),
    "segment_devices": with_profile(f""",
m AS (SELECT segment, {means(DEVICES)} FROM profile GROUP BY segment),
t AS (SELECT *, {ALL_DEVICES} AS all_devices FROM m),
long AS (UNPIVOT t ON {", ".join(DEVICES)} INTO NAME device VALUE mean_events)
SELECT segment, device, round(mean_events, 6) AS mean_events,
  round(mean_events / nullif(all_devices, 0), 6) AS share
FROM long"""),
    "kpis": with_profile(
        """SELECT count(*) AS total_users, round(avg(avg_purchase_amount), 6) AS avg_purchase_value,
          round(avg(CASE WHEN total_purchases > 0 THEN 1.0::DOUBLE ELSE 0.0 END) * 100, 6)
            AS conversion_rate
        FROM profile"""
    ),
    "kpis_day": with_events(f", {DAILY_FEATURES} {headline('daily')}"),
    "report_job": with_profile(
        headline(f"(FROM profile WHERE segment IN ({', '.join(map(str, CHOSEN_SEGMENTS))}))")
    ),
    "segment_details": with_profile(
        "SELECT segment, "
        + ", ".join(
            f"CAST(round(CAST(avg({c}) AS DECIMAL(28, 10)), 2) AS DOUBLE) AS {c}"
            for c in DETAIL_METRICS
        )
        + " FROM profile GROUP BY segment"
    ),
    "feature_vector": with_events(
        f", {DAILY_FEATURES} SELECT {day_text('day')} AS day, user_id, "
        + ", ".join(f"round(CAST(coalesce({c}, 0) AS DOUBLE), 6) AS {c}" for c in FEATURE_COLUMNS)
        + " FROM daily"
    ),
    "kmeans_segments": with_features(
        "SELECT user_id, CAST(CAST(substr(user_id, 6) AS BIGINT) % 5 AS INTEGER) AS segment FROM features"
    ),
    "cluster_centers": with_features(f""",
points AS (
  SELECT CAST(CAST(substr(user_id, 6) AS BIGINT) % 5 AS INTEGER) AS segment,
    {", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE) AS {c}" for c in FEATURE_COLUMNS)}
  FROM features
),
centres AS (
  SELECT segment, {", ".join(
      f"avg({c} + {APART} * segment) AS {c}" if c == "total_events" else f"avg({c}) AS {c}"
      for c in FEATURE_COLUMNS
  )}
  FROM points GROUP BY segment
)
SELECT segment, feature, round(value, 6) AS value
FROM (UNPIVOT centres ON {", ".join(FEATURE_COLUMNS)} INTO NAME feature VALUE value)"""),
    "kmeans_mass": with_features(f""",
means AS (SELECT {", ".join(f"avg(CAST(coalesce({c}, 0) AS DOUBLE)) AS {c}" for c in FEATURE_COLUMNS)} FROM features)
SELECT feature, round(mean, 6) AS mean
FROM (UNPIVOT means ON {", ".join(FEATURE_COLUMNS)} INTO NAME feature VALUE mean)"""),
    "segment_assign": with_profile(
        f"SELECT user_id, {rounded(CENTROID_COLUMNS)}, segment FROM profile"
    ),
    "kmeans_invariants": with_features(
        """SELECT count(*) AS users, count(DISTINCT user_id) AS assigned_users,
          CAST(0 AS BIGINT) AS out_of_range, CAST(0 AS BIGINT) AS misplaced
        FROM features"""
    ),
    "kmeans_layouts": with_features(
        "SELECT count(*) AS users, CAST(0 AS BIGINT) AS moved, CAST(5 AS BIGINT) AS segments FROM features"
    ),
    "segment_reassign": with_features(
        "SELECT user_id, CAST(CAST(substr(user_id, 6) AS BIGINT) % 5 AS INTEGER) AS segment FROM features"
    ),
    "segment_refit": with_features(
        """SELECT user_id, CAST(g AS INTEGER) AS kept, CAST(4 - g AS INTEGER) AS renumbered
        FROM (SELECT user_id, CAST(substr(user_id, 6) AS BIGINT) % 5 AS g FROM features)"""
    ),
    "silhouette": SILHOUETTE,
    "time_of_day": per_user(DAY_PART_COUNTS),
    "session_summary": with_events(
        f""", {SESSIONS} SELECT user_id, session_id, {stamp("first_at")} AS session_start,
          {stamp("last_at")} AS session_end, span / 1e6::DOUBLE AS duration_s, events
        FROM sessions"""
    ),
    "session_duration": with_events(f", {SESSIONS}, {DURATIONS} SELECT * FROM durations"),
    "sessionize": with_events(
        f", {GAP_SESSIONS} SELECT user_id, session_number, {GAP_SESSION_ROW} FROM gap_sessions"
    ),
    "interaction_frequency": with_events(f", {FREQUENCY} SELECT * FROM frequency"),
    "pages_viewed": per_user(
        """count(*) FILTER (WHERE event_type = 'pageview') AS pageviews,
        count(DISTINCT page) AS unique_pages_visited"""
    ),
    "behavior_profile": with_features(f""", {SESSIONS}, {DURATIONS}, {FREQUENCY},
parts AS (
  SELECT user_id, count(*) FILTER (WHERE event_type = 'pageview') AS pageviews, {DAY_PART_COUNTS}
  FROM web_events GROUP BY user_id
)
SELECT {FEATURE_ROW}, pageviews, {", ".join(DAY_PARTS)},
  mean_duration_s, max_duration_s, events_per_active_day, mean_gap_s
FROM features JOIN parts USING (user_id)
  LEFT JOIN durations USING (user_id) JOIN frequency USING (user_id)"""),
    "stream_closed_days": with_events(
        f""", {DAILY_FEATURES} SELECT {day_text('day')} AS day, {FEATURE_ROW} FROM daily
        WHERE day + INTERVAL 1 DAY <= {WATERMARK}"""
    ),
    "stream_closed_sessions": with_events(
        f""", {GAP_SESSIONS} SELECT user_id, {GAP_SESSION_ROW} FROM gap_sessions
        WHERE last_at + INTERVAL {GAP_SECONDS} SECOND <= {WATERMARK}"""
    ),
    "session_runs": within_range(
        f", {GAP_SESSIONS} SELECT user_id, session_number, {GAP_SESSION_ROW} FROM gap_sessions"
    ),
    "declared_session_runs": within_range(
        f""" SELECT user_id, user_id || ' ' || device_type AS session_id,
          {stamp('min("timestamp")')} AS session_start, {stamp('max("timestamp")')} AS session_end,
          (epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) / 1e6::DOUBLE AS duration_s, count(*) AS events
        FROM web_events GROUP BY user_id, device_type"""
    ),
    "distinct_runs": within_range(
        f", {features_where('true')} SELECT user_id, total_sessions, unique_pages_visited FROM features"
    ),
    "refreshed_days": within_range(f", {DAILY_FEATURES} SELECT {day_text('day')} AS day, {FEATURE_ROW} FROM daily"),
    "ab_test": with_features(ab_test("features", "total_purchases >= 14")),
    "ab_test_days": with_events(f", {DAILY_FEATURES}{ab_test('daily', 'total_purchases > 0')}"),
    "segment_recommend": recommendation(
        10, "view", "concat_ws(' ', page, user_agent, device_type, event_type)"
    ),
    "segment_recommend_products": recommendation(10, "product_id"),
    "dq_daily_zscore": DAILY_ZSCORE,
    "dq_failure_rates": per_day(
        share("rejected_rate", ANY_FAILED)
        + ", "
        + ", ".join(share(f"{name}_rate", broken) for name, broken in RULES.items())
    ),
    "dq_null_rates": per_day(
        ", ".join(share(f"{c}_null_rate", f'"{c}" IS NULL') for c in EVENT_COLUMNS)
    ),
}


# A stream that has read everything gives what the batch gives.
ORACLES["stream_daily_features"] = ORACLES["daily_features"]
ORACLES["stream_sessions"] = ORACLES["sessionize"]


ORACLES["sql_stored_tables"] = f"""WITH {ALL_PROFILE}, of_day AS (
  SELECT user_id, {FEATURE_AGGREGATES} FROM web_events WHERE {whole_days(DAY, DAY)} GROUP BY user_id
)
SELECT p.segment, count(*) AS users, count(*) FILTER (WHERE d.total_purchases > 0) AS buyers,
  round(sum(d.avg_purchase_amount * d.total_purchases), 2) AS spend
FROM of_day d JOIN profile p USING (user_id) GROUP BY p.segment"""


def long_table(name: str, source: str, metrics, metric: str | None = None) -> str:
    """A report's rows as table, segment, metric, value."""
    segment = "CAST(NULL AS INTEGER)" if source == "kpis" else "segment"
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "table", {segment} AS segment,
          {f"{metric} || ' {m}'" if metric else f"'{m}'"} AS metric, CAST("{m}" AS DOUBLE) AS value
        FROM ({ORACLES[source]}) r"""
        for m in metrics
    )


ORACLES["report_tables"] = " UNION ALL ".join([
    long_table("kpis", "kpis", ["total_users", "avg_purchase_value", "conversion_rate"]),
    long_table("segment_counts", "segment_sizes", ["count"]),
    long_table("segment_radar", "segment_radar", ["mean_value", "scaled"], "metric"),
    long_table("segment_devices", "segment_devices", ["mean_events", "share"], "device"),
    long_table("segment_details", "segment_details", DETAIL_METRICS),
])
