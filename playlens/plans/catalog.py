"""The query catalog: name -> (Spark plan builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)``, reads whole driver tables and
returns a lazy DataFrame. Column names match the oracle's exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.config import scratch_path
from playlens.functions.stats import numeric_summary, present
from playlens.functions.time import as_wall_clock, calendar_start, epoch_seconds, seconds_to
from playlens.operators import charts, profile, sarima, seasonal, series, sessions, sessionstore, trees, trend
from playlens.plans import oracle as O
from playlens.plans.inputs import (
    EVENT_GAP,
    EVENT_GAP_LONG,
    ORDER_GAP,
    SERIES_KEY,
    SERIES_Y,
    event_index,
    event_sessions,
    keyed_series,
    order_index,
)
from playlens.sources import sinks
from playlens.sources.plays import (
    PLAY_COLUMNS,
    event_plays,
    good_plays,
    load_track_data,
    order_plays,
    plays_to_raw,
    read_raw_tsv,
    scan_lines,
    write_raw_tsv,
)

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}

KEYS = [SERIES_KEY]
T = "count_months"
FILTER_USER = "7"


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        # operators return full precision; the comparison is made on rounded values
        REGISTRY[name] = (lambda spark, sf: present(fn(spark, sf)), None if sql is None else O.fold_negative_zero(sql))
        return fn

    return deco


def _out_plays(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    return df.select(
        *[as_wall_clock(c).alias(c) if c == "timestamp" else F.col(c) for c in PLAY_COLUMNS], *extra
    )


# ===========================================================================
# E: sessions (events, 20 min and 6 h)
# ===========================================================================

for _suffix, _gap in (("", EVENT_GAP), ("_6h", EVENT_GAP_LONG)):

    def _mk(gap=_gap, suffix=_suffix):
        S = O.event_sessions(gap)

        @register(f"sessionize{suffix}", f"""{S}
SELECT {O.PLAY_COLS}, session_id FROM sessions""")
        def _sessionize(spark, sf, gap=gap):
            return _out_plays(event_sessions(spark, sf, gap), ("session_id",))

        @register(f"session_count{suffix}", f"""{S}
SELECT count(*) AS session_count FROM (SELECT DISTINCT userid, session_id FROM sessions)""")
        def _session_count(spark, sf, gap=gap):
            return sessions.session_count(event_index(spark, sf, gap))

        @register(f"avg_tracks_per_session{suffix}", f"""{S}
SELECT CAST(sum(n_plays) AS BIGINT) AS n_plays, count(*) AS n_sessions,
  round(sum(n_plays) / count(*), 6) AS avg_tracks_per_session FROM durations""")
        def _avg_tracks(spark, sf, gap=gap):
            return sessions.session_totals(sessions.sessions_from_index(event_index(spark, sf, gap)))

        @register(f"session_durations{suffix}", f"""{S}
SELECT userid, session_id, session_duration_sec FROM durations""")
        def _durations(spark, sf, gap=gap):
            return _durations_idx(spark, sf, gap)

        @register(f"longest_sessions{suffix}", f"""{S}
SELECT userid, session_id, session_duration_sec FROM durations
ORDER BY session_duration_sec DESC NULLS LAST, userid ASC NULLS FIRST, session_id LIMIT 10""")
        def _longest(spark, sf, gap=gap):
            return sessions.longest_sessions(_durations_idx(spark, sf, gap), 10)

        @register(f"top_tracks_longest_sessions{suffix}", f"""{S},
top AS (SELECT userid, session_id FROM durations
        ORDER BY session_duration_sec DESC NULLS LAST, userid ASC NULLS FIRST, session_id LIMIT 50)
SELECT s.track_name, count(*) AS play_count FROM sessions s JOIN top USING (userid, session_id)
GROUP BY s.track_name ORDER BY play_count DESC, s.track_name ASC NULLS FIRST LIMIT 10""")
        def _top_long(spark, sf, gap=gap):
            return sessions.top_tracks_by_index(event_plays(spark, sf), gap, 50, 10, rank_by="duration")

        @register(f"top_tracks_most_played_sessions{suffix}", f"""{S},
top AS (SELECT userid, session_id FROM durations
        ORDER BY n_plays DESC, session_duration_sec DESC NULLS LAST, userid ASC NULLS FIRST, session_id LIMIT 50)
SELECT s.track_name, count(*) AS play_count FROM sessions s JOIN top USING (userid, session_id)
GROUP BY s.track_name ORDER BY play_count DESC, s.track_name ASC NULLS FIRST LIMIT 10""")
        def _top_plays(spark, sf, gap=gap):
            return sessions.top_tracks_by_index(event_plays(spark, sf), gap, 50, 10, rank_by="plays")

    _mk()

_S20 = O.event_sessions(EVENT_GAP)


def _durations_idx(spark, sf, gap=EVENT_GAP):
    """E4 from the session index: no per-play sort or join."""
    per = sessions.sessions_from_index(event_index(spark, sf, gap))
    return per.select("userid", "session_id", "session_duration_sec")


@register("stored_session_durations", f"""{_S20}
SELECT userid, session_id, session_duration_sec, n_plays FROM durations""")
def _stored_durations(spark, sf):
    """The sessions of a store that got the plays in two interleaved batches,
    the second one twice."""
    path, plays = scratch_path(spark, "session-store"), event_plays(spark, sf)
    late = F.pmod(F.xxhash64("musicbrainz_track_id"), F.lit(2)) == 1
    for name, part in (("early", plays.filter(~late)), ("late", plays.filter(late)), ("late", plays.filter(late))):
        sessionstore.append_plays(part, path, name, EVENT_GAP)
    per = sessions.sessions_from_index(sessionstore.stored_index(spark, path, EVENT_GAP))
    return per.select("userid", "session_id", "session_duration_sec", "n_plays")


@register("session_duration_stats", f"""{_S20}
SELECT count(session_duration_sec) AS count, round(avg(session_duration_sec), 6) AS mean,
  round(stddev_samp(session_duration_sec), 6) AS stddev,
  min(session_duration_sec) AS min, max(session_duration_sec) AS max FROM durations""")
def _duration_stats(spark, sf):
    return numeric_summary(_durations_idx(spark, sf), "session_duration_sec")


@register("session_duration_stats_hours", f"""{_S20}
SELECT count(h) AS count, round(avg(h), 6) AS mean, round(stddev_samp(h), 6) AS stddev,
  round(min(h), 6) AS min, round(max(h), 6) AS max
FROM (SELECT CAST(session_duration_sec AS DOUBLE) / 3600.0 AS h FROM durations)""")
def _duration_stats_hours(spark, sf):
    d = _durations_idx(spark, sf).select(seconds_to("session_duration_sec", "hours").alias("h"))
    return numeric_summary(d, "h")


@register("duration_units", f"""{_S20}
SELECT userid, session_id, session_duration_sec,
  round(CAST(session_duration_sec AS DOUBLE) / 60.0, 6) AS session_duration_min,
  round(CAST(session_duration_sec AS DOUBLE) / 3600.0, 6) AS session_duration_hours
FROM durations""")
def _duration_units(spark, sf):
    d = _durations_idx(spark, sf)
    return d.select(
        "userid",
        "session_id",
        "session_duration_sec",
        seconds_to("session_duration_sec", "minutes").alias("session_duration_min"),
        seconds_to("session_duration_sec", "hours").alias("session_duration_hours"),
    )


def _labelled_preview(plays, tail):
    """Ten plays in order with their session ids. Ids are per user, so only
    the plays of the users of those ten rows are indexed."""
    rows = sinks.preview(plays, ["userid", "timestamp", "musicbrainz_track_id"], 10, tail=tail)
    users = rows.select(F.col("userid").alias("_u")).distinct()  # ten users at most
    own = plays.join(F.broadcast(users), F.col("userid").eqNullSafe(F.col("_u")), "left_semi")
    return sessions.add_session_ids(rows, EVENT_GAP, index=sessions.session_index(own, EVENT_GAP))


@register("preview", f"""{_S20}
SELECT userid, "timestamp", track_name, session_id FROM sessions
ORDER BY userid ASC NULLS FIRST, "timestamp" ASC NULLS FIRST, musicbrainz_track_id ASC NULLS FIRST LIMIT 10""")
def _preview(spark, sf):
    head = _labelled_preview(event_plays(spark, sf), tail=False)
    return head.select("userid", as_wall_clock("timestamp").alias("timestamp"), "track_name", "session_id")


@register("preview_tail", f"""{_S20}
SELECT userid, "timestamp", track_name, session_id FROM sessions
ORDER BY userid DESC NULLS LAST, "timestamp" DESC NULLS LAST, musicbrainz_track_id DESC NULLS LAST LIMIT 10""")
def _preview_tail(spark, sf):
    tail = _labelled_preview(event_plays(spark, sf), tail=True)
    return tail.select("userid", as_wall_clock("timestamp").alias("timestamp"), "track_name", "session_id")


# ===========================================================================
# U: user series (orders, 90-day gap)
# ===========================================================================

_SO = O.order_sessions(ORDER_GAP)
_SOU = _SO + ",\n" + O.user_sessions_cte()


@register("sessions_per_user", f"""{_SO}
SELECT userid, count(*) AS n_sessions FROM (SELECT DISTINCT userid, session_id FROM sessions) GROUP BY userid""")
def _sessions_per_user(spark, sf):
    return series.sessions_per_user(order_index(spark, sf))


@register("top_user", f"""{_SO}
SELECT userid, count(*) AS n_sessions FROM (SELECT DISTINCT userid, session_id FROM sessions) GROUP BY userid
ORDER BY n_sessions DESC, userid ASC NULLS FIRST LIMIT 1""")
def _top_user(spark, sf):
    return series.top_user(order_index(spark, sf))


@register("user_sessions", f"""{_SOU}
SELECT userid, session_id, session_start, session_duration_sec FROM user_sessions""")
def _user_sessions(spark, sf):
    us = series.user_sessions_from_index(order_index(spark, sf))
    return us.select("userid", "session_id", as_wall_clock("session_start").alias("session_start"), "session_duration_sec")


_MONTHLY = """monthly AS (
  SELECT userid, date_trunc('month', session_start) AS timestamp_month,
    avg(session_duration_sec) AS avg_session_duration_sec
  FROM user_sessions GROUP BY userid, date_trunc('month', session_start))"""


@register("monthly_session_duration", f"""{_SOU},
{_MONTHLY}
SELECT userid, timestamp_month, round(avg_session_duration_sec, 6) AS avg_session_duration_sec FROM monthly""")
def _monthly(spark, sf):
    m = series.monthly_session_duration(series.user_sessions_from_index(order_index(spark, sf)))
    return m.select("userid", "timestamp_month", F.col("avg_session_duration_sec").alias("avg_session_duration_sec"))


@register("month_counter", f"""{_SOU},
{_MONTHLY}
SELECT userid, timestamp_month, round(avg_session_duration_sec, 6) AS avg_session_duration_sec,
  CAST(row_number() OVER (PARTITION BY userid ORDER BY timestamp_month) - 1 AS INTEGER) AS count_months
FROM monthly""")
def _month_counter(spark, sf):
    m = series.monthly_session_duration(series.user_sessions_from_index(order_index(spark, sf)))
    return series.add_month_counter(m).select(
        "userid", "timestamp_month", F.col("avg_session_duration_sec").alias("avg_session_duration_sec"),
        "count_months",
    )


@register("calendar_series", f"""{_SOU},
{_MONTHLY},
spine AS (
  SELECT userid, unnest(generate_series(min(timestamp_month), max(timestamp_month), INTERVAL 1 MONTH)) AS timestamp_month
  FROM monthly GROUP BY userid),
regular AS (
  SELECT s.userid, s.timestamp_month, m.avg_session_duration_sec AS own,
    row_number() OVER (PARTITION BY s.userid ORDER BY s.timestamp_month) - 1 AS t
  FROM spine s LEFT JOIN monthly m ON m.userid = s.userid AND m.timestamp_month = s.timestamp_month),
sides AS (
  SELECT *, last_value(own IGNORE NULLS) OVER b AS v0, first_value(own IGNORE NULLS) OVER a AS v1,
    max(CASE WHEN own IS NOT NULL THEN t END) OVER b AS t0, min(CASE WHEN own IS NOT NULL THEN t END) OVER a AS t1
  FROM regular
  WINDOW b AS (PARTITION BY userid ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    a AS (PARTITION BY userid ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT userid, timestamp_month, CAST(t AS INTEGER) AS count_months, own IS NULL AS filled,
  round(CASE WHEN own IS NOT NULL THEN own ELSE v0 + (v1 - v0) * (CAST(t - t0 AS DOUBLE) / (t1 - t0)) END, 6) AS avg_session_duration_sec
FROM sides""")
def _calendar_series(spark, sf):
    m = series.monthly_session_duration(series.user_sessions_from_index(order_index(spark, sf)))
    return series.fill_calendar(m, fill="linear")


@register("top_user_monthly_series", f"""{_SOU},
top AS (SELECT userid FROM (SELECT DISTINCT userid, session_id FROM sessions) GROUP BY userid
        ORDER BY count(*) DESC, userid ASC NULLS FIRST LIMIT 1),
{_MONTHLY}
SELECT userid, timestamp_month,
  CAST(row_number() OVER (PARTITION BY userid ORDER BY timestamp_month) - 1 AS INTEGER) AS count_months,
  round(avg_session_duration_sec, 6) AS avg_session_duration_sec
FROM monthly WHERE userid IN (SELECT userid FROM top)""")
def _top_user_series(spark, sf):
    # the top user matches no NULL user: without them first, both branches share one shuffle
    idx = order_index(spark, sf).where(F.col("userid").isNotNull())
    s = series.top_user_monthly_series(idx, per_session=series.user_sessions_from_index(idx))
    return s.select("userid", "timestamp_month", "count_months", F.col("avg_session_duration_sec").alias("avg_session_duration_sec"))


@register("user_with_longest_session", f"""{_SOU}
SELECT userid, max(session_duration_sec) AS longest_session_sec,
  CAST(sum(session_duration_sec) AS BIGINT) AS total_session_sec, count(*) AS n_sessions
FROM user_sessions GROUP BY userid
ORDER BY longest_session_sec DESC NULLS LAST, total_session_sec DESC NULLS LAST, userid ASC NULLS FIRST LIMIT 1""")
def _user_longest(spark, sf):
    return series.user_with_longest_session(None, per_session=series.user_sessions_from_index(order_index(spark, sf)))


# ===========================================================================
# D, P: profiling and scalar functions (events; yearly/monthly also on orders)
# ===========================================================================

_EP = "WITH plays AS (" + O.EVENT_PLAYS + ")"
_OP = "WITH plays AS (" + O.ORDER_PLAYS + ")"


@register("row_count", f"{_EP}\nSELECT count(*) AS n_rows FROM plays")
def _row_count(spark, sf):
    return profile.row_count(event_plays(spark, sf))


@register("null_report", f"""{_EP},
tot AS (SELECT count(*) AS n, {", ".join(f"count(*) FILTER (WHERE {('"timestamp"' if c == "timestamp" else c)} IS NULL) AS {c}_nulls" for c in PLAY_COLUMNS)} FROM plays)
{" UNION ALL ".join(f"SELECT '{c}' AS column, {c}_nulls AS null_count, round({c}_nulls * 100.0 / n, 6) AS null_pct FROM tot" for c in PLAY_COLUMNS)}""")
def _null_report(spark, sf):
    return profile.null_report(event_plays(spark, sf))


_STRING_COLS = [c for c in PLAY_COLUMNS if c != "timestamp"]


@register("column_summary", f"""{_EP}
{" UNION ALL ".join(f"SELECT '{c}' AS column, count({c}) AS count, round(avg(TRY_CAST({c} AS DOUBLE)), 6) AS mean, round(stddev_samp(TRY_CAST({c} AS DOUBLE)), 6) AS stddev, min({c}) AS min, max({c}) AS max FROM plays" for c in _STRING_COLS)}""")
def _column_summary(spark, sf):
    return profile.column_summary(event_plays(spark, sf))


def _date_range_sql(p):
    return f"""{p}
SELECT min("timestamp") AS min_date, max("timestamp") AS max_date,
  CAST(floor((epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) / 86400000000) AS BIGINT) AS duration_days
FROM plays"""


@register("date_range", _date_range_sql(_EP))
def _date_range(spark, sf):
    return profile.date_range(event_plays(spark, sf))


@register("date_range_orders", _date_range_sql(_OP))
def _date_range_orders(spark, sf):
    return profile.date_range(order_plays(spark, sf))


def _by_year_sql(p):
    return f"""{p}
SELECT CAST(year("timestamp") AS INTEGER) AS year, count(*) AS track_count FROM plays GROUP BY 1"""


def _by_month_sql(p):
    return f"""{p}
SELECT date_trunc('month', "timestamp") AS month, count(*) AS track_count FROM plays GROUP BY 1"""


@register("activity_by_year", _by_year_sql(_EP))
def _by_year(spark, sf):
    return profile.activity_by_year(event_plays(spark, sf))


@register("activity_by_year_orders", _by_year_sql(_OP))
def _by_year_o(spark, sf):
    return profile.activity_by_year(order_plays(spark, sf))


@register("activity_by_month", _by_month_sql(_EP))
def _by_month(spark, sf):
    return profile.activity_by_month(event_plays(spark, sf))


@register("activity_by_month_orders", _by_month_sql(_OP))
def _by_month_o(spark, sf):
    return profile.activity_by_month(order_plays(spark, sf))


@register("distinct_users", f"{_EP}\nSELECT count(*) AS n_users FROM (SELECT DISTINCT userid FROM plays)")
def _distinct_users(spark, sf):
    return profile.distinct_users(event_plays(spark, sf))


@register("user_activity_stats", f"""{_EP},
pu AS (SELECT userid, count(*) AS track_count FROM plays GROUP BY userid)
SELECT count(track_count) AS count, round(avg(track_count), 6) AS mean, round(stddev_samp(track_count), 6) AS stddev,
  min(track_count) AS min, max(track_count) AS max FROM pu""")
def _user_stats(spark, sf):
    return profile.user_activity_stats(event_plays(spark, sf))


@register("top_artists", f"""{_EP}
SELECT artist_name, count(*) AS play_count FROM plays GROUP BY artist_name
ORDER BY play_count DESC, artist_name ASC NULLS FIRST LIMIT 20""")
def _top_artists(spark, sf):
    return profile.top_artists(event_plays(spark, sf), 20)


@register("top_tracks", f"""{_EP}
SELECT track_name, artist_name, count(*) AS play_count FROM plays GROUP BY track_name, artist_name
ORDER BY play_count DESC, track_name ASC NULLS FIRST, artist_name ASC NULLS FIRST LIMIT 20""")
def _top_tracks(spark, sf):
    return profile.top_tracks(event_plays(spark, sf), 20)


@register("filter_user", f"{_EP}\nSELECT {O.PLAY_COLS} FROM plays WHERE userid = '{FILTER_USER}'")
def _filter_user(spark, sf):
    return _out_plays(profile.filter_user(event_plays(spark, sf, FILTER_USER), FILTER_USER))


@register("epoch_seconds", f"""{_EP}
SELECT musicbrainz_track_id, userid, CAST(floor(epoch("timestamp")) AS BIGINT) AS epoch_sec FROM plays""")
def _epoch(spark, sf):
    return event_plays(spark, sf).select("musicbrainz_track_id", "userid", epoch_seconds("timestamp").alias("epoch_sec"))


@register("calendar_parts", f"""{_OP}
SELECT musicbrainz_track_id, CAST(year("timestamp") AS INTEGER) AS year,
  date_trunc('year', "timestamp") AS year_start, date_trunc('month', "timestamp") AS month_start,
  date_trunc('week', "timestamp") AS week_start, date_trunc('day', "timestamp") AS day_start
FROM plays""")
def _calendar(spark, sf):
    p = order_plays(spark, sf)
    return p.select(
        "musicbrainz_track_id",
        F.year("timestamp").alias("year"),
        *[as_wall_clock(calendar_start("timestamp", g)).alias(f"{g}_start") for g in ("year", "month", "week", "day")],
    )


# ===========================================================================
# S: sources and sinks (round trips through the shared checkpoint folder)
# ===========================================================================


@register("tsv_scan", f"""{_EP}
SELECT userid, strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%fZ') AS "timestamp", musicbrainz_artist_id, artist_name,
  musicbrainz_track_id, track_name FROM plays""")
def _tsv_scan(spark, sf):
    path = scratch_path(spark, "tsv_scan")
    write_raw_tsv(event_plays(spark, sf), path, exact=True)
    return read_raw_tsv(spark, path, exact=True)


def _write_log(spark, sf, name: str) -> str:
    """The events as a plain log: one line each, nothing escaped. By event id, a
    title is quoted, partly quoted, opens a quote or is missing with its tab, or the
    timestamp is none."""
    kind = F.col("musicbrainz_track_id").cast("long") % 6
    title = (
        F.when(kind == 0, F.concat(F.lit('"'), "artist_name", F.lit('"')))
        .when(kind == 1, F.concat("artist_name", F.lit(' "live" take')))
        .when(kind == 2, F.concat(F.lit('"'), "artist_name"))
        .otherwise(F.col("artist_name"))
    )
    time = F.when(kind == 4, F.lit("unknown")).otherwise(F.col("timestamp"))
    fields = [F.coalesce(c, F.lit("")) for c in (F.col("userid"), time, *map(F.col, ("musicbrainz_artist_id", "artist_name", "musicbrainz_track_id")))]
    path = scratch_path(spark, name)
    line = F.concat_ws("\t", *fields, F.when(kind != 3, title))
    plays_to_raw(event_plays(spark, sf)).select(line.alias("value")).write.text(path)
    return path


# The same log; a scan with default quoting drops the marks of a quoted title and of one whose quote stays open.
_LOG = f"""{_EP},
log AS (SELECT *, CAST(musicbrainz_track_id AS BIGINT) % 6 AS kind,
          CASE WHEN CAST(musicbrainz_track_id AS BIGINT) % 6 <> 4 THEN strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%fZ') ELSE 'unknown' END AS stamp,
          CASE CAST(musicbrainz_track_id AS BIGINT) % 6 WHEN 0 THEN '"' || artist_name || '"' WHEN 1 THEN artist_name || ' "live" take'
            WHEN 2 THEN '"' || artist_name WHEN 3 THEN NULL ELSE artist_name END AS title FROM plays)"""


@register("tsv_scan_quoted", f"""{_LOG}
SELECT userid, stamp AS "timestamp", musicbrainz_artist_id, artist_name, musicbrainz_track_id,
  CASE WHEN kind IN (0, 2) THEN artist_name ELSE title END AS track_name FROM log""")
def _tsv_scan_quoted(spark, sf):
    return read_raw_tsv(spark, _write_log(spark, sf, "plain_log"))


@register("tsv_rejected", f"""{_LOG}
SELECT CASE kind WHEN 3 THEN 'fields' ELSE 'timestamp' END AS reason,
  concat_ws(chr(9), userid, stamp, coalesce(musicbrainz_artist_id, ''), artist_name, musicbrainz_track_id, title) AS line
FROM log WHERE kind IN (3, 4)""")
def _tsv_rejected(spark, sf):
    path = scratch_path(spark, "rejected")
    sinks.write_rejected(scan_lines(spark, _write_log(spark, sf, "plain_log")), path)
    return sinks.read_rejected(spark, path)


@register("tsv_good_plays", f"""{_LOG}
SELECT userid, "timestamp", musicbrainz_artist_id, artist_name, musicbrainz_track_id,
  CASE WHEN kind IN (0, 2) THEN artist_name ELSE title END AS track_name FROM log WHERE kind NOT IN (3, 4)""")
def _tsv_good(spark, sf):
    good = good_plays(scan_lines(spark, _write_log(spark, sf, "plain_log")))
    return good.withColumn("timestamp", as_wall_clock("timestamp"))


@register("timestamp_parse", f"{_EP}\nSELECT musicbrainz_track_id, \"timestamp\" FROM plays")
def _ts_parse(spark, sf):
    path = scratch_path(spark, "timestamp_parse")
    write_raw_tsv(event_plays(spark, sf), path, exact=True)
    return load_track_data(spark, path, exact=True).select("musicbrainz_track_id", as_wall_clock("timestamp").alias("timestamp"))


@register("tsv_sink", f"""{_S20},
top AS (SELECT userid, session_id FROM durations
        ORDER BY session_duration_sec DESC NULLS LAST, userid ASC NULLS FIRST, session_id LIMIT 50)
SELECT s.track_name, count(*) AS play_count FROM sessions s JOIN top USING (userid, session_id)
GROUP BY s.track_name ORDER BY play_count DESC, s.track_name ASC NULLS FIRST LIMIT 10""")
def _tsv_sink(spark, sf):
    path = scratch_path(spark, "tsv_sink")
    top = sessions.top_tracks_by_index(event_plays(spark, sf), EVENT_GAP, 50, 10)
    sinks.write_tsv(top, path, single_file=True)
    return sinks.read_tsv(spark, path, "track_name string, play_count bigint")


# ===========================================================================
# M: trend models on the keyed series
# ===========================================================================

_KS = O.keyed_series(ORDER_GAP)


def _series(spark, sf, shared: bool = False):
    """The keyed series. ``shared=True`` for plans that read it in several
    differently-pruned branches: it is then written once to the shared
    checkpoint folder instead of being recomputed per branch
    (``keyed_series(materialize=True)``)."""
    return keyed_series(spark, sf, materialize=shared)


@register("keyed_series", f"""{_KS}
SELECT series_key, timestamp_month, count_months, round(y, 6) AS {SERIES_Y} FROM series""")
def _keyed(spark, sf):
    s = _series(spark, sf)
    return s.select(SERIES_KEY, "timestamp_month", T, F.col(SERIES_Y).alias(SERIES_Y))


@register("train_test_split", f"""{_KS},
{O.split_ctes()}
SELECT series_key, count_months, round(y, 6) AS {SERIES_Y}, split FROM xy""")
def _split(spark, sf):
    s = trend.train_test_split(_series(spark, sf), KEYS, T)
    return s.select(SERIES_KEY, T, F.col(SERIES_Y).alias(SERIES_Y), "split")


@register("kfold", f"""{_KS},
{O.split_ctes()}
SELECT series_key, count_months,
  CAST(ntile(3) OVER (PARTITION BY series_key ORDER BY count_months) - 1 AS INTEGER) AS fold FROM train""")
def _kfold(spark, sf):
    tr = trend.train_test_split(_series(spark, sf), KEYS, T).filter(F.col("split") == "train")
    return trend.kfold(tr, KEYS, T).select(SERIES_KEY, T, "fold")


def _fit_sql(models: tuple[str, ...], extra: str) -> str:
    return f"""{_KS},
{O.split_ctes()},
{O.grid_values(models)},
trsums AS (SELECT series_key, {O.SUMS} FROM train GROUP BY series_key),
fits AS ({O.with_coefficients("(SELECT s.*, g.* FROM trsums s CROSS JOIN grid g)")})
SELECT series_key, {extra}, round(slope, 6) AS slope, round(intercept, 6) AS intercept,
  CAST(n AS BIGINT) AS n_train FROM fits"""


def _train(spark, sf):
    return trend.train_test_split(_series(spark, sf), KEYS, T).filter(F.col("split") == "train")


@register("ols", _fit_sql(("LinearRegression",), "fit_intercept"))
def _ols(spark, sf):
    return trend.fit_linear_regression(_train(spark, sf), KEYS, T, SERIES_Y)


@register("ridge", _fit_sql(("Ridge",), "alpha"))
def _ridge(spark, sf):
    return trend.fit_ridge(_train(spark, sf), KEYS, T, SERIES_Y)


@register("lasso", _fit_sql(("Lasso",), "alpha"))
def _lasso(spark, sf):
    return trend.fit_lasso(_train(spark, sf), KEYS, T, SERIES_Y)


_GS = f"{_KS},\n{O.grid_search_ctes()}"


@register("grid_search", f"""{_GS}
SELECT series_key, model, grid_pos, best_params, round(cv_mse_raw, 6) AS cv_mse, CAST(NULL AS VARCHAR) AS reason FROM winners""")
def _grid_search(spark, sf):
    return trend.grid_search(_series(spark, sf, shared=True), KEYS, T, SERIES_Y)


_MET = _GS + O.metrics_ctes()


@register("test_metrics", f"""{_MET}
SELECT series_key, model, best_params, round(mse, 6) AS mse, round(rmse, 6) AS rmse, round(r2, 6) AS r2,
  CAST(NULL AS VARCHAR) AS reason FROM metrics""")
def _test_metrics(spark, sf):
    return trend.test_metrics(_series(spark, sf, shared=True), KEYS, T, SERIES_Y)


@register("leaderboard", f"{_MET}\nSELECT series_key, model, best_params, rmse, r2, rank, CAST(NULL AS VARCHAR) AS reason FROM board")
def _leaderboard(spark, sf):
    return trend.leaderboard(_series(spark, sf, shared=True), KEYS, T, SERIES_Y)


@register("model_comparison", f"""{_MET}
SELECT series_key, model, 'rmse' AS metric, rmse AS value FROM board
UNION ALL SELECT series_key, model, 'r2' AS metric, r2 AS value FROM board""")
def _model_comparison(spark, sf):
    return charts.model_comparison(trend.leaderboard(_series(spark, sf, shared=True), KEYS, T, SERIES_Y), KEYS)


_OLS_FC = f"""{_KS},
{O.split_ctes()},
trsums AS (SELECT series_key, {O.SUMS} FROM train GROUP BY series_key),
coef AS ({O.with_coefficients("(SELECT s.*, 'LinearRegression' AS model, TRUE AS fit_intercept, CAST(NULL AS DOUBLE) AS alpha FROM trsums s)")}),
last AS (SELECT series_key, max(count_months) AS last_t, max(timestamp_month) AS last_month FROM series GROUP BY series_key),
fc AS (
  SELECT l.series_key, h.h, CAST(l.last_t + h.h AS INTEGER) AS t, l.last_month,
    c.intercept + c.slope * CAST(l.last_t + h.h AS INTEGER) AS forecast
  FROM last l JOIN coef c ON l.series_key = c.series_key CROSS JOIN (VALUES (1), (2), (3)) h(h))"""


def _ols_forecast(spark, sf):
    s = _series(spark, sf, shared=True)
    tr = trend.train_test_split(s, KEYS, T).filter(F.col("split") == "train")
    sums = trend.fit_sums(tr, KEYS, T, SERIES_Y)
    coefs = trend.coefficients(sums, model="'LinearRegression'", fit_intercept="true", alpha="CAST(NULL AS DOUBLE)")
    return trend.forecast_future_periods(s, coefs, KEYS, T, 3)


@register("trend_forecast", f"{_OLS_FC}\nSELECT series_key, t, round(forecast, 6) AS forecast FROM fc")
def _trend_forecast(spark, sf):
    return _ols_forecast(spark, sf).select(SERIES_KEY, "t", F.col("forecast").alias("forecast"))


@register("forecast_calendar", f"""{_OLS_FC}
SELECT series_key, CAST(CAST(last_month AS DATE) + to_months(CAST(h AS INTEGER)) AS TIMESTAMP) AS month, t,
  round(forecast, 6) AS forecast_{SERIES_Y} FROM fc""")
def _forecast_calendar(spark, sf):
    return trend.create_forecast_calendar(_ols_forecast(spark, sf), KEYS, f"forecast_{SERIES_Y}")


_BEST_FC = f"""{_MET},
chosen AS (
  SELECT w.series_key, w.model, w.best_params AS params, g.fit_intercept, g.alpha
  FROM winners w JOIN board b ON w.series_key = b.series_key AND w.model = b.model AND b.rank = 1
  JOIN grid g ON w.model = g.model AND w.grid_pos = g.grid_pos),
bcoef AS ({O.with_coefficients("(SELECT c.*, s.n, s.sxx, s.sxy, s.avgx, s.avgy, s.sum_xx, s.sum_xy FROM chosen c JOIN trsums s ON c.series_key = s.series_key)")}),
last AS (SELECT series_key, max(count_months) AS last_t, max(timestamp_month) AS last_month FROM series GROUP BY series_key),
bfc AS (
  SELECT l.series_key, c.model, h.h, CAST(l.last_t + h.h AS INTEGER) AS t, l.last_month,
    c.intercept + c.slope * CAST(l.last_t + h.h AS INTEGER) AS forecast
  FROM last l JOIN bcoef c ON l.series_key = c.series_key CROSS JOIN (VALUES (1), (2), (3)) h(h))"""


@register("best_model_forecast", f"""{_BEST_FC}
SELECT series_key, CAST(CAST(last_month AS DATE) + to_months(CAST(h AS INTEGER)) AS TIMESTAMP) AS month, t,
  round(forecast, 6) AS forecast_{SERIES_Y}, model, round(forecast * 24.0, 6) AS forecast_avg_session_duration_hours
FROM bfc""")
def _best_forecast(spark, sf):
    return trend.best_model_forecast(
        _series(spark, sf, shared=True), KEYS, T, SERIES_Y, 3, value_col=f"forecast_{SERIES_Y}",
        unit_factor=24.0, unit_col="forecast_avg_session_duration_hours",
    ).drop("reason")  # the oracle's columns; the NULL row of an unscored key stays


_RIDGE_FC = f"""{_MET},
chosen AS (
  SELECT w.series_key, 'Ridge' AS model,
    CASE WHEN w.model = 'LinearRegression' THEN g.fit_intercept ELSE TRUE END AS fit_intercept,
    coalesce(g.alpha, 1.0) AS alpha
  FROM winners w JOIN board b ON w.series_key = b.series_key AND w.model = b.model AND b.rank = 1
  JOIN grid g ON w.model = g.model AND w.grid_pos = g.grid_pos),
bcoef AS ({O.with_coefficients("(SELECT c.*, s.n, s.sxx, s.sxy, s.avgx, s.avgy, s.sum_xx, s.sum_xy FROM chosen c JOIN trsums s ON c.series_key = s.series_key)")}),
last AS (SELECT series_key, max(count_months) AS last_t, max(timestamp_month) AS last_month FROM series GROUP BY series_key),
bfc AS (
  SELECT l.series_key, c.model, h.h, CAST(l.last_t + h.h AS INTEGER) AS t, l.last_month,
    c.intercept + c.slope * CAST(l.last_t + h.h AS INTEGER) AS forecast
  FROM last l JOIN bcoef c ON l.series_key = c.series_key CROSS JOIN (VALUES (1), (2), (3)) h(h))"""


@register("best_model_forecast_ridge", f"""{_RIDGE_FC}
SELECT series_key, CAST(CAST(last_month AS DATE) + to_months(CAST(h AS INTEGER)) AS TIMESTAMP) AS month, t,
  round(forecast, 6) AS forecast_{SERIES_Y}, model FROM bfc""")
def _best_forecast_ridge(spark, sf):
    """The reference's own behaviour (R5): a Ridge built from the winner's
    parameters, whatever model won."""
    return trend.best_model_forecast(
        _series(spark, sf, shared=True), KEYS, T, SERIES_Y, 3, family="ridge", value_col=f"forecast_{SERIES_Y}"
    ).drop("reason")


@register("coefficient_sink", f"""{_BEST_FC}
SELECT series_key, model, params, round(slope, 6) AS slope, round(intercept, 6) AS intercept FROM bcoef""")
def _coef_sink(spark, sf):
    """The chosen model per key with its train-fit coefficients, written as
    Parquet to the shared folder and read back."""
    s = _series(spark, sf, shared=True)
    coefs = trend.best_settings(s, KEYS, T, SERIES_Y).select(
        SERIES_KEY, "model", "params", F.col("slope").alias("slope"), F.col("intercept").alias("intercept")
    )
    path = scratch_path(spark, "coefficients")
    sinks.write_coefficients(coefs, path)
    return sinks.read_coefficients(spark, path)


# ===========================================================================
# T, V: diagnostics, seasonal forecast, chart tables
# ===========================================================================


@register("differencing", f"""{_KS}
SELECT series_key, count_months, round(d1, 6) AS diff_1, round(ds, 6) AS diff_seasonal,
  round(ds - lag(ds, 1) OVER w, 6) AS diff_both
FROM (SELECT *, y - lag(y, 1) OVER w AS d1, y - lag(y, 12) OVER w AS ds
      FROM series WINDOW w AS (PARTITION BY series_key ORDER BY count_months))
WINDOW w AS (PARTITION BY series_key ORDER BY count_months)""")
def _differencing(spark, sf):
    return seasonal.differencing(_series(spark, sf), KEYS, T, SERIES_Y)


_LIM = "least(CAST(ceil(10 * log10(nn.n)) AS BIGINT), nn.n // 2, nn.n - 1)"

_ACF_BASE = f"""{_KS},
dev AS (SELECT series_key, count_months, y - avg(y) OVER (PARTITION BY series_key) AS d FROM series),
nn AS (SELECT series_key, count(*) AS n FROM series GROUP BY series_key),
lags AS (SELECT nn.series_key, nn.n, {_LIM} AS lim, unnest(range(0, {_LIM} + 1)) AS k FROM nn),
prods AS (
  SELECT a.series_key, l.k, l.n, l.lim, sum(a.d * b.d) AS c
  FROM dev a JOIN lags l ON a.series_key = l.series_key
  JOIN dev b ON a.series_key = b.series_key AND b.count_months = a.count_months + l.k
  GROUP BY a.series_key, l.k, l.n, l.lim),
acfs AS (
  SELECT p.series_key, CAST(p.k AS INTEGER) AS lag, p.c / z.c AS acf, p.n, p.lim
  FROM prods p JOIN prods z ON p.series_key = z.series_key AND z.k = 0)"""


@register("acf", f"""{_ACF_BASE}
SELECT series_key, lag, round(acf, 6) AS acf, round(CASE WHEN lag = 0 THEN 0.0 ELSE 1.959963984540054 * sqrt((1 + 2 * coalesce(
    sum(acf * acf) FILTER (WHERE lag >= 1) OVER (PARTITION BY series_key ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    0.0)) / n) END, 6) AS band FROM acfs""")
def _acf(spark, sf):
    return seasonal.acf(_series(spark, sf), KEYS, T, SERIES_Y)


@register("pacf", f"""{_ACF_BASE},
rl AS (SELECT series_key, list(acf ORDER BY lag) AS r, max(n) AS n, least(max(lim), max(n) // 2 - 1) AS top FROM acfs GROUP BY series_key),
dl AS (
  SELECT series_key, r, n, top, 1 AS k, [r[2]] AS phi, r[2] AS pk FROM rl
  UNION ALL
  SELECT series_key, r, n, top, k + 1,
    list_append(list_transform(phi, lambda p, i: p - pk1 * phi[k + 1 - i]), pk1), pk1
  FROM (
    SELECT *, (r[k + 2] - coalesce(list_sum(list_transform(phi, lambda p, i: p * r[k + 2 - i])), 0.0))
              / (1.0 - coalesce(list_sum(list_transform(phi, lambda p, i: p * r[i + 1])), 0.0)) AS pk1
    FROM dl WHERE k < top))
SELECT series_key, CAST(k AS INTEGER) AS lag, round(pk, 6) AS pacf, round(1.959963984540054 / sqrt(n), 6) AS band
FROM dl WHERE k <= top""".replace(
    "dl AS (", "dl(series_key, r, n, top, k, phi, pk) AS (", 1
).replace("WITH ", "WITH RECURSIVE ", 1))
def _pacf(spark, sf):
    return seasonal.pacf(_series(spark, sf), KEYS, T, SERIES_Y)


_CDF = (
    "CASE WHEN {z} >= 0 THEN 1 - {t} ELSE {t} END"
)


def _normal_sql(z: str) -> str:
    """The normal CDF in SQL, by the same published approximation."""
    k = f"(1 / (1 + 0.2316419 * abs({z})))"
    series = f"{k} * (0.319381530 + {k} * (-0.356563782 + {k} * (1.781477937 + {k} * (-1.821255978 + {k} * 1.330274429))))"
    return _CDF.format(z=f"({z})", t=f"(exp(-({z}) * ({z}) / 2) / sqrt(2 * pi()) * {series})")


_P_VALUE = f"""CASE WHEN adf_statistic > 2.74 THEN 1.0 WHEN adf_statistic < -18.83 THEN 0.0
    WHEN adf_statistic <= -1.61 THEN {_normal_sql("2.1659 + 1.4412 * adf_statistic + 0.038269 * adf_statistic * adf_statistic")}
    ELSE {_normal_sql("1.7339 + 0.93202 * adf_statistic - 0.12745 * adf_statistic * adf_statistic - 0.010368 * adf_statistic * adf_statistic * adf_statistic")} END"""


@register("stationarity", f"""{_KS},
d0 AS (SELECT series_key, count_months, lag(y, 1) OVER w AS x, y - lag(y, 1) OVER w AS dy
       FROM series WINDOW w AS (PARTITION BY series_key ORDER BY count_months)),
d AS (SELECT *, lag(dy, 1) OVER (PARTITION BY series_key ORDER BY count_months) AS dl FROM d0),
s AS (SELECT series_key,
        regr_count(dy, x) AS n0, regr_slope(dy, x) AS b0, regr_sxx(dy, x) AS sxx0,
        regr_sxy(dy, x) AS sxy0, regr_syy(dy, x) AS syy0,
        count(*) FILTER (WHERE dl IS NOT NULL AND dy IS NOT NULL AND x IS NOT NULL) AS nc,
        var_pop(x) FILTER (WHERE dl IS NOT NULL) AS v11, var_pop(dl) FILTER (WHERE dl IS NOT NULL) AS v22,
        covar_pop(x, dl) FILTER (WHERE dl IS NOT NULL) AS v12, covar_pop(x, dy) FILTER (WHERE dl IS NOT NULL) AS v1y,
        covar_pop(dl, dy) FILTER (WHERE dl IS NOT NULL) AS v2y, var_pop(dy) FILTER (WHERE dl IS NOT NULL) AS vyy
      FROM d GROUP BY series_key),
f AS (SELECT *, (v22 * v1y - v12 * v2y) / (v11 * v22 - v12 * v12) AS b1,
        (v11 * v2y - v12 * v1y) / (v11 * v22 - v12 * v12) AS b2, v11 * v22 - v12 * v12 AS det FROM s),
g AS (SELECT *, nc * (vyy - b1 * v1y - b2 * v2y) AS ssr1, nc * (vyy - v1y * v1y / v11) AS ssr0c,
        b0 / sqrt((syy0 - sxy0 * sxy0 / sxx0) / (n0 - 2) / sxx0) AS t0 FROM f),
h AS (SELECT *, CASE WHEN ssr0c > 0 THEN nc * ln(ssr0c / nc) + 4.0 END AS aic0,
        CASE WHEN ssr1 > 0 THEN nc * ln(ssr1 / nc) + 6.0 END AS aic1,
        b1 / sqrt(ssr1 / (nc - 3) * v22 / (nc * det)) AS t1 FROM g),
k AS (SELECT series_key,
        CASE WHEN nc >= 4 AND aic1 IS NOT NULL AND aic0 IS NOT NULL AND aic1 < aic0 THEN 1 ELSE 0 END AS used_lag,
        n0, nc, t0, t1 FROM h),
st AS (SELECT series_key, used_lag, CASE WHEN used_lag = 1 THEN nc ELSE n0 END AS n_obs,
         CASE WHEN used_lag = 1 THEN t1 ELSE t0 END AS adf_statistic FROM k),
cr AS (SELECT *, -2.86154 - 2.8903 / CAST(n_obs AS DOUBLE) - 4.234 / (CAST(n_obs AS DOUBLE) * n_obs)
           - 40.040 / (CAST(n_obs AS DOUBLE) * n_obs * n_obs) AS critical_5pct, {_P_VALUE} AS p_value
       FROM st WHERE n_obs >= 3)
SELECT series_key, CAST(used_lag AS INTEGER) AS used_lag, CAST(n_obs AS BIGINT) AS n_obs,
  round(adf_statistic, 6) AS adf_statistic, round(p_value, 6) AS p_value, round(critical_5pct, 6) AS critical_5pct,
  p_value < 0.05 AS is_stationary, CAST(NULL AS VARCHAR) AS reason FROM cr""")
def _stationarity(spark, sf):
    return seasonal.stationarity(_series(spark, sf), KEYS, T, SERIES_Y)


@register("stationarity_autolag", None)
def _stationarity_autolag(spark, sf):
    """T4 with the AIC search over all lags (least squares per key; tests
    compare it with normal equations)."""
    return seasonal.stationarity_autolag(_series(spark, sf), KEYS, T, SERIES_Y)


_SEASONAL_SQL = f"""{_KS},
{O.seasonal_ctes()}
SELECT series_key, month, t, round(fc, 6) AS forecast, CAST(NULL AS VARCHAR) AS reason FROM s_fc"""


@register("seasonal_forecast", _SEASONAL_SQL)
def _seasonal_forecast(spark, sf):
    return seasonal.seasonal_forecast(_series(spark, sf), KEYS, T, SERIES_Y)


@register("forecast_evaluation", f"""{_KS},
bigt AS (SELECT series_key, max(count_months) AS big_t FROM series GROUP BY series_key),
fit AS (SELECT s.* FROM series s JOIN bigt b USING (series_key) WHERE s.count_months <= b.big_t - 3),
{O.seasonal_ctes("fit", "h_")},
pairs AS (SELECT f.series_key, f.fc - s.y AS e FROM h_fc f JOIN series s ON f.series_key = s.series_key AND f.t = s.count_months)
SELECT series_key, count(*) AS n_compared, round(avg(abs(e)), 6) AS mae, round(avg(e * e), 6) AS mse,
  round(sqrt(avg(e * e)), 6) AS rmse FROM pairs GROUP BY series_key""")
def _forecast_eval(spark, sf):
    return seasonal.forecast_evaluation(_series(spark, sf, shared=True), KEYS, T, SERIES_Y)


@register("forecast_evaluation_reference", f"""{_KS},
{O.seasonal_ctes()},
bigt AS (SELECT series_key, max(count_months) AS big_t FROM series GROUP BY series_key),
obs AS (SELECT s.series_key, CAST(s.count_months + 3 AS INTEGER) AS t, s.y
        FROM series s JOIN bigt b USING (series_key) WHERE s.count_months > b.big_t - 3),
pairs AS (SELECT f.series_key, f.fc - o.y AS e FROM s_fc f JOIN obs o ON f.series_key = o.series_key AND f.t = o.t)
SELECT series_key, count(*) AS n_compared, round(avg(abs(e)), 6) AS mae, round(avg(e * e), 6) AS mse,
  round(sqrt(avg(e * e)), 6) AS rmse FROM pairs GROUP BY series_key""")
def _forecast_eval_ref(spark, sf):
    """The reference's own comparison (R6): forecasts for T+1..T+n against the
    observations T-n+1..T, by position."""
    return seasonal.forecast_evaluation(_series(spark, sf, shared=True), KEYS, T, SERIES_Y, align="reference")


@register("forecast_chart", f"""{_KS},
{O.seasonal_ctes()}
SELECT series_key, timestamp_month AS month, round(y, 6) AS value, 'observed' AS series FROM series
UNION ALL SELECT series_key, month, round(fc, 6) AS value, 'forecast' AS series FROM s_fc""")
def _forecast_chart(spark, sf):
    s = _series(spark, sf, shared=True)
    fc = seasonal.seasonal_forecast(s, KEYS, T, SERIES_Y).where(F.col("reason").isNull())
    return charts.observed_and_forecast(s, fc, KEYS, "timestamp_month", SERIES_Y, "forecast")


# ===========================================================================
# Tree ensembles per series; forecasts from any winner
# ===========================================================================


@register("random_forest", None)
def _random_forest(spark, sf):
    return trees.tree_test_metrics(_series(spark, sf, shared=True), KEYS, T, SERIES_Y, "random_forest")


@register("gbt", None)
def _gbt(spark, sf):
    return trees.tree_test_metrics(_series(spark, sf, shared=True), KEYS, T, SERIES_Y, "gbt")


@register("leaderboard_all_models", None)
def _leaderboard_all(spark, sf):
    return trees.leaderboard_with_trees(_series(spark, sf, shared=True), KEYS, T, SERIES_Y)


@register("best_of_all_forecast", None)
def _best_of_all(spark, sf):
    return trees.best_of_all_forecast(_series(spark, sf, shared=True), KEYS, T, SERIES_Y)


@register("tree_model_sink", None)
def _tree_sink(spark, sf):
    """Write the forests' step functions to the shared folder, read them back
    and predict the held-out rows with them."""
    s = _series(spark, sf, shared=True)
    path = scratch_path(spark, "tree_models")
    sinks.write_coefficients(trees.fit_tree_models(s, KEYS, T, SERIES_Y, ("random_forest",)), path)
    models = sinks.read_coefficients(spark, path).select(*KEYS, "bounds", "values")
    test = trend.train_test_split(s, KEYS, T).where("split = 'test'").select(*KEYS, T, SERIES_Y)
    return test.join(models, KEYS).select(*KEYS, T, SERIES_Y, trees.step_value("bounds", "values", T).alias("prediction"))


# ===========================================================================
# T5 with the caller's orders (iterated fit; no SQL oracle - rows only)
# ===========================================================================


@register("seasonal_arima_closed_form", _SEASONAL_SQL)
def _arima_closed(spark, sf):
    """The iterated fit at the orders that have a closed form."""
    found = sarima.seasonal_arima_forecast(_series(spark, sf, shared=True), KEYS, T, SERIES_Y, (1, 1, 0), (0, 1, 0, 12))
    return found.drop("lower", "upper")


@register("seasonal_arima_fit", None)
def _arima_fit(spark, sf):
    found = sarima.seasonal_arima(_series(spark, sf), KEYS, T, SERIES_Y, (1, 1, 1), (1, 1, 1, 12))
    first = lambda c: F.col(c)[0].alias(c)
    return found.select(*KEYS, *[first(c) for c in ("ar", "seasonal_ar", "ma", "seasonal_ma")], "sse", "n_residuals", "reason")


@register("seasonal_arima_forecast", None)
def _arima_forecast(spark, sf):
    return sarima.seasonal_arima_forecast(_series(spark, sf, shared=True), KEYS, T, SERIES_Y, (1, 1, 1), (1, 1, 1, 12), periods=3)


def queries() -> dict[str, Builder]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    queries()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
