"""The SQL each query is compared with, over the same tables."""

from __future__ import annotations

from reddwatch.params import ZONE

_HOME_A = "('5','6','7','8','9','10','11','12')"

_DETECTIONS = """
det0 AS (
  SELECT o_custkey AS pit_id, cast(c_nationkey AS varchar) AS release_sitecode,
         CASE o_orderstatus WHEN 'F' THEN 'Adult' ELSE 'Juvenile' END AS release_lifestage,
         make_date(cast(1995 + c_custkey % 7 AS int), cast(1 + c_custkey % 12 AS int), 1)
           AS release_datetime,
         split_part(o_orderpriority, ' ', 1) AS observation_sitecode,
         o_orderdate AS observation_datetime,
         cast(floor(c_acctbal) AS double) AS length_mm,
         cast(month(o_orderdate) AS bigint) AS observation_month,
         cast(year(o_orderdate) AS bigint) AS observation_year,
         cast(CASE WHEN month(o_orderdate) > 6 THEN year(o_orderdate) + 1
                   ELSE year(o_orderdate) END AS bigint) AS spawn_year
  FROM orders JOIN customer ON o_custkey = c_custkey),
det_all AS (
  SELECT *, cast(year(release_datetime) AS bigint) AS release_year,
         cast(observation_year - year(release_datetime) AS bigint) AS yrs_at_large FROM det0),
det_years AS (
  SELECT * FROM det_all WHERE yrs_at_large <> 0 OR release_lifestage <> 'Juvenile'),
det_now AS (
  SELECT * FROM det_years WHERE spawn_year = (SELECT max(spawn_year) FROM det0))"""

_OUT = """pit_id, release_sitecode, release_lifestage, release_datetime, observation_sitecode,
  observation_datetime, yrs_at_large, spawn_year, length_mm"""

_SITES = """
sites AS (
  SELECT cast(n_nationkey AS varchar) AS site_code, n_name AS site_name,
         CASE WHEN n_regionkey <> 4 THEN n_nationkey * 1.5e0 END AS latitude,
         CASE WHEN n_regionkey <> 4 THEN n_regionkey * 10.0e0 - 120 END AS longitude
  FROM nation)"""

_GROUPS = """
site_groups(site_group, site_code, is_presence, is_entry) AS (VALUES
  ('A', '1-URGENT', true, true), ('A', '2-HIGH', true, false), ('A', '5-LOW', false, false),
  ('B', '3-MEDIUM', true, false), ('B', '4-NOT', true, true), ('B', '5-LOW', false, false)),
homes AS (
  SELECT CASE WHEN code <= 12 THEN 'A' ELSE 'B' END AS site_group,
         cast(code AS varchar) AS home FROM range(5, 21) r(code))"""


def _flagged(source: str) -> str:
    """Detections of group A with its flags."""
    return f"""
flagged AS (
  SELECT 'A' AS site_group, *, observation_sitecode IN ('1-URGENT', '2-HIGH') AS is_presence,
         observation_sitecode = '1-URGENT' AS is_entry,
         release_sitecode IN {_HOME_A} AS is_home_release FROM {source})"""


def _group_flagged(source: str) -> str:
    """Detections of every group their site belongs to."""
    return f"""{_GROUPS},
flagged AS (
  SELECT d.*, g.site_group, is_presence, is_entry, home IS NOT NULL AS is_home_release
  FROM {source} d JOIN site_groups g ON observation_sitecode = g.site_code
  LEFT JOIN homes h ON h.site_group = g.site_group AND home = release_sitecode)"""


_TAGS = """
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY site_group, spawn_year, pit_id
    ORDER BY observation_datetime, release_sitecode, release_lifestage, release_datetime) AS rn
  FROM flagged),
tags AS (
  SELECT site_group, spawn_year, pit_id,
         min(CASE WHEN is_presence THEN observation_datetime END) AS yfk_first,
         max(CASE WHEN is_entry THEN observation_datetime END) AS yfk_entry_final,
         round(avg(length_mm), 8) AS length_mm,
         max(CASE WHEN rn = 1 THEN release_lifestage END) AS release_lifestage,
         max(CASE WHEN rn = 1 THEN release_sitecode END) AS release_sitecode,
         max(CASE WHEN rn = 1 THEN release_datetime END) AS release_datetime,
         max(CASE WHEN is_home_release AND release_lifestage = 'Juvenile' THEN 1 ELSE 0 END)
           AS home_juvenile
  FROM ranked GROUP BY site_group, spawn_year, pit_id)"""

_INDIVIDUALS = """
individuals AS (
  SELECT site_group, spawn_year, pit_id, yfk_first, yfk_entry_final,
         round(date_diff('microsecond', yfk_first, yfk_entry_final) / 86400e6, 8) AS yfk_diff,
         length_mm, release_lifestage, release_sitecode, release_datetime
  FROM tags
  WHERE home_juvenile = 0 OR pit_id IN (SELECT l_suppkey FROM lineitem))"""

_INDIVIDUAL_OUT = """pit_id, yfk_first, yfk_entry_final, yfk_diff, length_mm,
  release_lifestage, release_sitecode, release_datetime, spawn_year"""

_DAILY = """
by_day AS (
  SELECT site_group, spawn_year, cast(yfk_entry_final AS date) AS yfk_final_date, count(*) AS n
  FROM individuals GROUP BY ALL),
running AS (
  SELECT *, cast(sum(n) OVER (PARTITION BY site_group, spawn_year) AS bigint) AS sy_total,
         cast(sum(n) OVER (PARTITION BY site_group, spawn_year
           ORDER BY yfk_final_date ASC NULLS LAST ROWS UNBOUNDED PRECEDING) AS bigint)
           AS cumulative_total
  FROM by_day),
daily AS (
  SELECT site_group, yfk_final_date, n, sy_total, cumulative_total,
         round(n / sy_total, 6) AS daily_prop,
         round(cumulative_total / sy_total, 6) AS daily_cumulative, spawn_year FROM running)"""

_DAILY_OUT = """yfk_final_date, n, sy_total, cumulative_total, daily_prop, daily_cumulative,
  spawn_year"""

_LOCATIONS = _SITES + """,
located AS (
  SELECT site_group, spawn_year, pit_id, release_sitecode, release_lifestage, site_name,
         latitude, longitude
  FROM tags LEFT JOIN sites ON release_sitecode = site_code)"""

_LOCATION_OUT = """pit_id, release_sitecode, release_lifestage, site_name, latitude, longitude,
  spawn_year"""

_FLOW = """
flow AS (
  SELECT cast(ts AS date) AS date,
         round(avg(CASE WHEN event_type = 'view' THEN value END), 8) AS mean_temp,
         round(avg(CASE WHEN event_type = 'click' THEN value END), 8) AS mean_discharge
  FROM events WHERE event_type IN ('view', 'click') GROUP BY 1)"""

_LENGTHS = """
adults AS (
  SELECT p_retailprice AS length_mm FROM part
  WHERE p_type = 'ECONOMY' AND p_retailprice IS NOT NULL),
bins AS (
  SELECT floor(length_mm / 25) * 25 AS length_bin, count(*) AS freq,
         (SELECT count(*) FROM adults) AS total_sample,
         (SELECT avg(length_mm) FROM adults) AS mean_length
  FROM adults GROUP BY 1)"""

_NOW = f"WITH {_DETECTIONS},{_flagged('det_now')},{_TAGS}"
_YEARS = f"WITH {_DETECTIONS},{_flagged('det_years')},{_TAGS}"
_BY_GROUP = f"WITH {_DETECTIONS},{_group_flagged('det_years')},{_TAGS}"

# The log keeps one row per tag, site and time; repeats take the larger release attributes.
_LOGGED = """
logged AS (
  SELECT pit_id, observation_sitecode, observation_datetime,
         max(release_sitecode) AS release_sitecode,
         max(release_lifestage) AS release_lifestage,
         max(release_datetime) AS release_datetime, max(length_mm) AS length_mm,
         max(yrs_at_large) AS yrs_at_large, max(spawn_year) AS spawn_year
  FROM det_all GROUP BY 1, 2, 3),
logged_years AS (
  SELECT * FROM logged WHERE yrs_at_large <> 0 OR release_lifestage <> 'Juvenile')"""

_REPORT = """
report AS (
  SELECT printf('3DD.%010X', o_custkey) AS pit_id, substr(c_mktsegment, 1, 1) AS rear_type,
         cast(c_nationkey AS varchar) AS release_sitecode,
         CASE o_orderstatus WHEN 'F' THEN 'Adult' ELSE 'Juvenile' END AS release_lifestage,
         make_date(cast(1995 + c_custkey % 7 AS int), cast(1 + c_custkey % 12 AS int), 1)
           AS release_datetime,
         split_part(o_orderpriority, ' ', 1) AS observation_sitecode,
         o_orderdate AS observation_datetime,
         cast(month(o_orderdate) AS bigint) AS observation_month,
         cast(year(o_orderdate) AS bigint) AS observation_year,
         CASE WHEN c_acctbal >= 0 AND c_mktsegment NOT IN ('MACHINERY', 'BUILDING')
              THEN c_acctbal END AS length_mm,
         c_acctbal
  FROM orders JOIN customer ON o_custkey = c_custkey
              JOIN nation ON c_nationkey = n_nationkey)"""

_ENTRY_WINDOW = "yfk_final_date BETWEEN DATE '2001-07-10' AND DATE '2001-07-25'"
_GAUGE_WINDOW = "date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'"

ORACLE: dict[str, str] = {
    "report_scan": f"""WITH {_REPORT}
      SELECT pit_id, rear_type, release_sitecode, release_lifestage, release_datetime,
             cast(year(release_datetime) AS bigint) AS release_year, observation_sitecode,
             observation_datetime, observation_month, observation_year,
             cast(observation_year - year(release_datetime) AS bigint) AS yrs_at_large,
             CASE WHEN observation_month > 6 THEN observation_year + 1
                  ELSE observation_year END AS spawn_year, length_mm
      FROM report""",
    "downstream_scan": """
      SELECT DISTINCT printf('3DD.%010X', l_suppkey) AS pit_id FROM lineitem""",
    "report_rejects": f"""WITH {_REPORT}
      SELECT count(*) AS n_rows, cast(0 AS bigint) AS bad_obs_time,
             cast(0 AS bigint) AS bad_release_date,
             count(CASE WHEN c_acctbal < 0 THEN 1 END) AS bad_length
      FROM report""",
    "sites_scan": f"WITH {_SITES} SELECT * FROM sites",
    "sites_of_group": f"WITH {_SITES} SELECT * FROM sites WHERE site_code IN {_HOME_A}",
    "gauge_scan": """
      SELECT 'G' AS site_no, cast(ts AS date) AS date, event_type AS parameter_cd,
             count(*) AS n_readings, round(sum(value), 4) AS total
      FROM events
      WHERE event_type IN ('view', 'click')
        AND cast(ts AS date) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
      GROUP BY 1, 2, 3""",
    "gauge_wide_to_long": f"""WITH {_FLOW}
      SELECT 'G' AS site_no, date, 'view' AS parameter_cd, mean_temp AS value
      FROM flow WHERE mean_temp IS NOT NULL
      UNION ALL
      SELECT 'G', date, 'click', mean_discharge FROM flow WHERE mean_discharge IS NOT NULL""",
    "watch_list_hits": f"""WITH {_DETECTIONS}
      SELECT printf('3DD.%010X', pit_id) AS pit_id, release_sitecode, release_lifestage,
             release_datetime, observation_sitecode, observation_datetime, yrs_at_large,
             spawn_year, length_mm
      FROM det_all WHERE pit_id IN (SELECT s_suppkey FROM supplier)""",
    "watch_list_malformed": "SELECT s_name AS pit_id FROM supplier",
    "detections_all": f"""WITH {_DETECTIONS}
      SELECT {_OUT}, release_year, observation_month, observation_year FROM det_all""",
    "most_recent_year": f"""WITH {_DETECTIONS}
      SELECT spawn_year, (SELECT max(spawn_year) FROM det0) AS most_recent, count(*) AS n
      FROM det_all GROUP BY 1""",
    "detections_current": f"""WITH {_DETECTIONS}
      SELECT {_OUT}, spawn_year AS most_recent FROM det_now""",
    "same_year_juveniles_dropped": f"WITH {_DETECTIONS} SELECT {_OUT} FROM det_years",
    "site_flags": f"""WITH {_DETECTIONS},{_flagged('det_all')}
      SELECT observation_sitecode, release_sitecode, is_presence, is_entry, is_home_release,
             count(*) AS n
      FROM flagged GROUP BY ALL""",
    "site_group_flags": f"""WITH {_DETECTIONS},{_group_flagged('det_all')}
      SELECT site_group, observation_sitecode, release_sitecode, is_presence, is_entry,
             is_home_release, count(*) AS n
      FROM flagged GROUP BY ALL""",
    "home_juveniles": f"""WITH {_DETECTIONS},{_flagged('det_now')}
      SELECT DISTINCT pit_id FROM flagged
      WHERE release_lifestage = 'Juvenile' AND is_home_release""",
    "juvenile_not_downstream": f"""WITH {_DETECTIONS},{_flagged('det_now')}
      SELECT DISTINCT pit_id FROM flagged
      WHERE release_lifestage = 'Juvenile' AND is_home_release
        AND pit_id NOT IN (SELECT l_suppkey FROM lineitem)""",
    "detections_kept": f"""WITH {_DETECTIONS},{_flagged('det_now')}
      SELECT {_OUT} FROM flagged
      WHERE pit_id IN (SELECT l_suppkey FROM lineitem) OR pit_id NOT IN (
        SELECT pit_id FROM flagged WHERE release_lifestage = 'Juvenile' AND is_home_release)""",
    "tag_first_release": f"""WITH {_DETECTIONS}
      SELECT pit_id, release_sitecode, release_datetime FROM (
        SELECT *, row_number() OVER (PARTITION BY pit_id ORDER BY observation_datetime,
          release_sitecode, release_lifestage, release_datetime) AS rn FROM det_years)
      WHERE rn = 1""",
    "individuals": f"{_NOW},{_INDIVIDUALS} SELECT {_INDIVIDUAL_OUT} FROM individuals",
    "individuals_joined": f"{_NOW},{_INDIVIDUALS} SELECT {_INDIVIDUAL_OUT} FROM individuals",
    "individuals_by_group":
        f"{_BY_GROUP},{_INDIVIDUALS} SELECT {_INDIVIDUAL_OUT}, site_group FROM individuals",
    "entry_daily_cumulative":
        f"{_NOW},{_INDIVIDUALS},{_DAILY} SELECT {_DAILY_OUT} FROM daily",
    "entry_daily_by_year":
        f"{_YEARS},{_INDIVIDUALS},{_DAILY} SELECT {_DAILY_OUT} FROM daily",
    "entry_daily_by_group":
        f"{_BY_GROUP},{_INDIVIDUALS},{_DAILY} SELECT {_DAILY_OUT}, site_group FROM daily",
    "locations": f"{_NOW},{_LOCATIONS} SELECT {_LOCATION_OUT} FROM located",
    "locations_by_group":
        f"{_BY_GROUP},{_LOCATIONS} SELECT {_LOCATION_OUT}, site_group FROM located",
    "site_lifestage_counts": f"""{_YEARS},{_LOCATIONS}
      SELECT spawn_year, release_sitecode, site_name, latitude, longitude, release_lifestage,
             count(*) AS n_tags
      FROM located GROUP BY ALL""",
    "grid_clusters": f"""{_YEARS},{_LOCATIONS}
      SELECT floor(latitude / 5) * 5 AS cell_latitude,
             floor(longitude / 5) * 5 AS cell_longitude, release_lifestage, count(*) AS n_tags
      FROM located WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY ALL""",
    "length_frequency": f"""WITH {_LENGTHS}
      SELECT length_bin, freq, total_sample, round(mean_length, 8) AS mean_length FROM bins""",
    "length_frequency_by_group": f"""{_BY_GROUP},{_INDIVIDUALS},
      adults AS (
        SELECT * FROM individuals
        WHERE release_lifestage = 'Adult' AND length_mm IS NOT NULL),
      totals AS (
        SELECT site_group, spawn_year, count(*) AS total_sample,
               round(avg(length_mm), 8) AS mean_length
        FROM adults GROUP BY ALL),
      bins AS (
        SELECT site_group, spawn_year, floor(length_mm / 25) * 25 AS length_bin,
               count(*) AS freq
        FROM adults GROUP BY ALL)
      SELECT length_bin, freq, total_sample, mean_length, site_group, spawn_year
      FROM bins JOIN totals USING (site_group, spawn_year)""",
    "gauge_daily_wide": f"WITH {_FLOW} SELECT 'G' AS site_no, * FROM flow",
    "gauge_sites_wide": """
      SELECT cast(user_id AS varchar) AS site_no, cast(ts AS date) AS date,
             round(avg(CASE WHEN event_type = 'view' THEN value END), 8) AS mean_temp,
             round(avg(CASE WHEN event_type = 'click' THEN value END), 8) AS mean_discharge
      FROM events WHERE event_type IN ('view', 'click') GROUP BY 1, 2""",
    "flow_range": f"""WITH {_FLOW}
      SELECT date, mean_temp, mean_discharge, cast(1 AS bigint) AS "group"
      FROM flow WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'""",
    "series_window": f"""
      SELECT 'G' AS site_no, cast(ts AS date) AS date, event_type AS parameter_cd, value
      FROM events
      WHERE cast(ts AS date) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""",
    "discharge_series": f"""WITH {_FLOW}
      SELECT date, mean_discharge, cast(1 AS bigint) AS "group",
             ' Date: ' || strftime(date, '%Y-%m-%d') || ' <br> Mean Discharge (cfs):  '
               || printf('%.15g', mean_discharge) AS text
      FROM flow WHERE {_GAUGE_WINDOW}""",
    "temperature_series": f"""WITH {_FLOW}
      SELECT date, mean_temp, cast(1 AS bigint) AS "group",
             ' Date: ' || strftime(date, '%Y-%m-%d') || ' <br> Mean Temp (C):  '
               || printf('%.15g', mean_temp) AS text
      FROM flow WHERE {_GAUGE_WINDOW}""",
    "year_to_date": f"""{_NOW},{_INDIVIDUALS},{_DAILY}
      SELECT yfk_final_date, cumulative_total, spawn_year,
             ' Date: ' || strftime(yfk_final_date, '%b %d') || ' <br> Number In: '
               || cumulative_total AS text
      FROM daily WHERE {_ENTRY_WINDOW}""",
    "entries_by_day": f"""{_NOW},{_INDIVIDUALS},{_DAILY}
      SELECT yfk_final_date, n, spawn_year,
             ' Date: ' || strftime(yfk_final_date, '%Y-%m-%d')
               || ' <br> Number Steelhead Entered: ' || n AS text
      FROM daily WHERE {_ENTRY_WINDOW}""",
    "tooltip_text": f"""{_YEARS},{_INDIVIDUALS},{_DAILY}
      SELECT spawn_year, yfk_final_date,
             ' Date: ' || strftime(yfk_final_date, '%b %d') || ' <br> Number In: '
               || cumulative_total AS text
      FROM daily""",
    "length_bars": f"""WITH {_LENGTHS}
      SELECT length_bin, freq, 'Length Bin: ' || printf('%.15g', length_bin)
             || '<br>Number: ' || freq AS text FROM bins""",
    "length_annotations": f"""WITH {_LENGTHS}
      SELECT round(max(mean_length), 8) AS mean_length, 'N = ' || max(total_sample) AS n_label,
             'Mean Length = ' || printf('%.15g', round_even(max(mean_length), 0)) || ' mm'
               AS mean_label,
             round(min(length_bin) * 1.05e0, 8) AS label_x,
             round(max(freq) * 0.88e0, 8) AS n_label_y,
             round(max(freq) * 0.95e0, 8) AS mean_label_y
      FROM bins""",
    "bin_edges": f"""WITH {_LENGTHS}
      SELECT unnest(range(cast(min(length_bin) AS bigint),
                          cast(max(length_bin) AS bigint) + 1, 25)) AS length_bin
      FROM bins""",
    "map_points": f"""{_YEARS},{_LOCATIONS}
      SELECT latitude, longitude, release_lifestage, release_sitecode, site_name,
             '<b>Site Code: </b>' || release_sitecode || '<br><b>Site Name: </b>' || site_name
               AS popup,
             CASE release_lifestage WHEN 'Juvenile' THEN 'cyan' WHEN 'Adult' THEN 'magenta'
               ELSE '#808080' END AS colour
      FROM located WHERE latitude IS NOT NULL AND longitude IS NOT NULL""",
    "unique_tags": f"{_NOW},{_INDIVIDUALS} SELECT count(*) AS n_tags FROM individuals",
    "new_in_last_week": f"""{_NOW},{_INDIVIDUALS}
      SELECT count(*) AS n_new FROM individuals
      WHERE yfk_entry_final >= TIMESTAMP '2001-07-24 00:00:00'""",
    "trailing_week": """
      SELECT count(*) AS n_new FROM events WHERE ts >= TIMESTAMP '2024-01-23 00:00:00'""",
    "default_start": f"""{_NOW},{_INDIVIDUALS},{_DAILY}
      SELECT cast(min(yfk_final_date) - 14 AS date) AS date_start FROM daily""",
    "default_start_by_gauge": """
      SELECT cast(min(cast(ts AS date)) - 14 AS date) AS date_start FROM events""",
    "saved_individuals": f"""{_BY_GROUP},{_INDIVIDUALS}
      SELECT {_INDIVIDUAL_OUT}, site_group FROM individuals
      WHERE spawn_year = (SELECT max(spawn_year) FROM individuals)""",
    "saved_daily":
        f"{_BY_GROUP},{_INDIVIDUALS},{_DAILY} SELECT {_DAILY_OUT}, site_group FROM daily",
    "saved_locations":
        f"{_BY_GROUP},{_LOCATIONS} SELECT {_LOCATION_OUT}, site_group FROM located",
    "saved_flow": f"""WITH {_FLOW}
      SELECT date, mean_temp, mean_discharge, cast(1 AS bigint) AS "group" FROM flow
      WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'""",
    "season_overwrite":
        f"{_YEARS},{_INDIVIDUALS},{_DAILY} SELECT {_DAILY_OUT} FROM daily",
    "incremental_daily": f"""
      WITH {_DETECTIONS},{_LOGGED},{_group_flagged('logged_years')},{_TAGS},{_INDIVIDUALS},
      {_DAILY} SELECT {_DAILY_OUT}, site_group FROM daily""",
    "incremental_detections": f"""
      WITH {_DETECTIONS},{_LOGGED} SELECT {_OUT} FROM logged""",
}

# A window served from a saved table gives the rows of the same window over the source.
ORACLE["saved_series_window"] = ORACLE["discharge_series"]
ORACLE["report_scan_split"] = ORACLE["report_scan"]
ORACLE["report_scan_blocks"] = ORACLE["report_scan"]
# What is restated or comes late ends in the state of the whole table.
ORACLE["incremental_restated"] = ORACLE["incremental_detections"]
ORACLE["incremental_late"] = ORACLE["incremental_daily"]

ORACLE.update({
    "zoned_passage": f"""
      WITH seen AS (
        SELECT user_id, date_trunc('second', ts + INTERVAL 62 DAY) AS wall FROM events),
      placed AS (SELECT user_id, wall, epoch_us(wall AT TIME ZONE '{ZONE}') AS instant FROM seen)
      SELECT user_id, cast(arg_min(wall, instant) AS date) AS first_date,
             cast(arg_max(wall, instant) AS date) AS last_date,
             round((max(instant) - min(instant)) / 86400e6, 8) AS yfk_diff
      FROM placed GROUP BY user_id""",
    "discharge_in_order": f"""
      SELECT cast(user_id AS varchar) AS site_no, cast(ts AS date) AS date,
             round(avg(CASE WHEN event_type = 'click' THEN value END), 8) AS mean_discharge,
             row_number() OVER (PARTITION BY user_id ORDER BY cast(ts AS date)) AS place
      FROM events WHERE event_type IN ('view', 'click') AND {_GAUGE_WINDOW.replace("date", "cast(ts AS date)", 1)}
      GROUP BY user_id, cast(ts AS date)""",
    "entries_until_today": f"""{_YEARS},{_INDIVIDUALS},{_DAILY}
      SELECT yfk_final_date, cumulative_total, spawn_year,
             row_number() OVER (PARTITION BY spawn_year ORDER BY yfk_final_date) AS place
      FROM daily WHERE yfk_final_date BETWEEN DATE '1998-03-01' AND current_date""",
    "gauge_landed_twice": """
      SELECT site_no, cast(ts AS date) AS date, event_type AS parameter_cd,
             count(*) AS n_readings, round(sum(value), 4) AS total
      FROM events, (VALUES ('G'), ('H')) s(site_no)
      WHERE event_type IN ('view', 'click')
        AND cast(ts AS date) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
      GROUP BY 1, 2, 3""",
    "unmatched_sites": f"""WITH {_DETECTIONS}
      SELECT observation_sitecode, spawn_year, count(*) AS n FROM det_all
      WHERE observation_sitecode NOT IN ('1-URGENT', '2-HIGH', '5-LOW') GROUP BY 1, 2""",
    "flow_by_site": """
      SELECT cast(user_id AS varchar) AS site_no, cast(ts AS date) AS date,
             round(avg(CASE WHEN event_type = 'view' THEN value END), 8) AS mean_temp,
             round(avg(CASE WHEN event_type = 'click' THEN value END), 8) AS mean_discharge,
             cast(1 AS bigint) AS "group"
      FROM events
      WHERE event_type IN ('view', 'click')
        AND cast(ts AS date) BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'
      GROUP BY 1, 2""",
    "year_to_date_by_group": f"""{_BY_GROUP},{_INDIVIDUALS},{_DAILY}
      SELECT site_group, yfk_final_date, cumulative_total, spawn_year,
             ' Date: ' || strftime(yfk_final_date, '%b %d') || ' <br> Number In: '
               || cumulative_total AS text
      FROM daily WHERE {_ENTRY_WINDOW}""",
    "unique_tags_by_group": f"""{_BY_GROUP},{_INDIVIDUALS}
      SELECT site_group, spawn_year, count(*) AS n_tags FROM individuals GROUP BY 1, 2""",
    "unique_tags_all_groups": f"""{_BY_GROUP},{_INDIVIDUALS}
      SELECT count(DISTINCT pit_id) AS n_tags FROM individuals""",
    "length_bars_by_group": f"""{_BY_GROUP},{_INDIVIDUALS}
      SELECT site_group, spawn_year, length_bin, freq,
             'Length Bin: ' || printf('%.15g', length_bin) || '<br>Number: ' || freq AS text
      FROM (SELECT site_group, spawn_year, floor(length_mm / 25) * 25 AS length_bin,
                   count(*) AS freq
            FROM individuals WHERE release_lifestage = 'Adult' AND length_mm IS NOT NULL
            GROUP BY ALL)""",
    "map_points_by_group": f"""{_BY_GROUP},{_LOCATIONS}
      SELECT site_group, spawn_year, latitude, longitude, release_lifestage, release_sitecode,
             site_name,
             '<b>Site Code: </b>' || release_sitecode || '<br><b>Site Name: </b>' || site_name
               AS popup,
             CASE release_lifestage WHEN 'Juvenile' THEN 'cyan' WHEN 'Adult' THEN 'magenta'
               ELSE '#808080' END AS colour
      FROM located WHERE latitude IS NOT NULL AND longitude IS NOT NULL""",
    "default_start_by_group": f"""{_BY_GROUP},{_INDIVIDUALS},{_DAILY}
      SELECT site_group, spawn_year, cast(min(yfk_final_date) - 14 AS date) AS date_start
      FROM daily GROUP BY 1, 2""",
    "incremental_mixed_headers": f"""WITH {_REPORT}
      SELECT pit_id, max(release_sitecode) AS release_sitecode,
             max(release_lifestage) AS release_lifestage, max(release_datetime) AS release_datetime,
             observation_sitecode, observation_datetime,
             cast(max(observation_year - year(release_datetime)) AS bigint) AS yrs_at_large,
             max(CASE WHEN observation_month > 6 THEN observation_year + 1 ELSE observation_year END)
               AS spawn_year, max(length_mm) AS length_mm
      FROM report GROUP BY pit_id, observation_sitecode, observation_datetime""",
    "reports_set_aside": "SELECT 'Other,Thing' AS header, count(*) AS n_rows FROM nation",
    "cluster_pyramid": f"""{_YEARS},{_LOCATIONS},
      cells AS (
        SELECT least(floor((longitude + 180) / 360 * 128), 127) AS x,
               least(floor((latitude + 90) / 180 * 128), 127) AS y, latitude, longitude
        FROM located WHERE latitude IS NOT NULL AND longitude IS NOT NULL)
      SELECT cast(level AS bigint) AS level, cast(floor(x / 2 ** (7 - level)) AS bigint) AS cell_x,
             cast(floor(y / 2 ** (7 - level)) AS bigint) AS cell_y, count(*) AS n_tags,
             round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude
      FROM cells, range(8) levels(level) GROUP BY 1, 2, 3""",
    "season_curves": f"""{_BY_GROUP},{_INDIVIDUALS},{_DAILY},
      axis AS (
        SELECT site_group, spawn_year, sy_total, cast(unnest(generate_series(
                 make_date(cast(spawn_year - 1 AS int), 7, 1), make_date(cast(spawn_year AS int), 6, 30),
                 INTERVAL 1 DAY)) AS date) AS date
        FROM (SELECT DISTINCT site_group, spawn_year, sy_total FROM daily))
      SELECT a.site_group, a.spawn_year, date,
             cast(date_diff('day', DATE '1999-07-01', make_date(
               CASE WHEN month(date) > 6 THEN 1999 ELSE 2000 END, month(date), day(date))) + 1 AS bigint)
               AS season_day,
             coalesce(d.n, 0) AS n, cast(coalesce(sum(d.n) OVER season, 0) AS bigint) AS cumulative_total,
             round(coalesce(sum(d.n) OVER season, 0) / a.sy_total, 6) AS daily_cumulative
      FROM axis a LEFT JOIN daily d ON d.site_group = a.site_group AND d.spawn_year = a.spawn_year
        AND d.yfk_final_date = a.date
      WINDOW season AS (PARTITION BY a.site_group, a.spawn_year ORDER BY date ROWS UNBOUNDED PRECEDING)""",
})
ORACLE["published_tables"] = ORACLE["saved_daily"]
ORACLE["gauge_compacted"] = ORACLE["gauge_landed_twice"]
