"""DuckDB statements for the registered queries, written as plain range joins and windows."""

from __future__ import annotations

from energy_fixtures.adapters import EXCLUSION_ROWS, TARIFF_ROWS
from helioledger.operators.quality import NOT_NULL
from helioledger.schemas import INSTALLATION_COST, MEASURES

VALUES = ("grid", "solar", "battery", "home")


def _rows(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{cell}'" for cell in row) + ")" for row in rows)


# ---------------------------------------------------------------- raw tables

_TEXT = """strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H:%M') AS hour,
  CAST(home + battery - solar AS VARCHAR) AS grid, CAST(solar AS VARCHAR) AS solar,
  CAST(battery AS VARCHAR) AS battery, CAST(home AS VARCHAR) AS home"""

ONE_RAW = f"""hours AS (
  SELECT date_trunc('hour', ts) AS ts,
    CASE WHEN count(*) FILTER (event_type = 'purchase') > 0
         THEN coalesce(sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'view'), 0) END AS solar,
    coalesce(sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'click'), 0) AS home,
    coalesce(sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'signup'), 0)
      - coalesce(sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'error'), 0) AS battery
  FROM events GROUP BY 1),
raw AS (SELECT {_TEXT} FROM hours),
raw_tariffs(start_date, end_date, off_peak_start_hour, off_peak_end_hour, peak_rate, off_peak_rate, export_rate) AS (
  VALUES {_rows(TARIFF_ROWS)}),
raw_exclusions(start_date, start_time, end_date, end_time, exclusion_reason) AS (VALUES {_rows(EXCLUSION_ROWS)})"""

FLEET_RAW = f"""hours AS (
  SELECT l_suppkey AS site_id, CAST(l_shipdate AS TIMESTAMP) + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS ts,
    bool_or(l_linenumber <> 7) AS ok,
    coalesce(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (l_returnflag = 'A'), 0) AS a,
    coalesce(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (l_returnflag = 'N'), 0) AS n,
    sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_discount AS DECIMAL(18,2)) ELSE -CAST(l_tax AS DECIMAL(18,2)) END) * 100 AS b
  FROM lineitem GROUP BY 1, 2),
checked AS (
  SELECT site_id, ts, CASE WHEN ok THEN a END AS solar, CASE WHEN ok THEN n END AS home,
    CASE WHEN ok THEN CAST(b AS DECIMAL(18,2)) END AS battery
  FROM hours),
raw AS (SELECT site_id, {_TEXT} FROM checked),
raw_tariffs AS (
  SELECT s_suppkey AS site_id,
    strftime(DATE '1995-01-01' + CAST(s_suppkey % 300 AS INTEGER), '%Y-%m-%d') AS start_date,
    strftime(DATE '1998-06-30' + s_nationkey % 7, '%Y-%m-%d') AS end_date,
    '00:00' AS off_peak_start_hour, '04:00' AS off_peak_end_hour,
    CAST(CAST(0.27 + s_nationkey % 10 * 0.0011 AS DECIMAL(8,4)) AS VARCHAR) AS peak_rate,
    CAST(CAST(0.07 + s_nationkey % 10 * 0.0009 AS DECIMAL(8,4)) AS VARCHAR) AS off_peak_rate,
    '0.1510' AS export_rate
  FROM supplier
  UNION ALL
  SELECT s_suppkey, '1998-07-01',
    CASE WHEN s_nationkey % 11 <> 0 THEN strftime(DATE '2001-06-30' + CAST(s_suppkey % 90 AS INTEGER), '%Y-%m-%d') END,
    CASE WHEN s_nationkey % 5 = 0 THEN '23:00' ELSE '01:00' END,
    CASE WHEN s_nationkey % 5 = 0 THEN '05:00' ELSE '06:00' END,
    CAST(CAST(0.25 + s_nationkey % 10 * 0.0013 AS DECIMAL(8,4)) AS VARCHAR),
    CAST(CAST(0.04 + s_nationkey % 10 * 0.0007 AS DECIMAL(8,4)) AS VARCHAR),
    '0.1500'
  FROM supplier),
outages AS (
  SELECT o_custkey, o_orderpriority, CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS s,
    to_hours(CAST(floor(o_totalprice) AS BIGINT) % 1000) AS length
  FROM orders),
raw_exclusions AS (
  SELECT o_custkey AS site_id, strftime(s, '%Y-%m-%d') AS start_date, strftime(s, '%H:%M:%S') AS start_time,
    strftime(s + length, '%Y-%m-%d') AS end_date, strftime(s + length, '%H:%M:%S') AS end_time,
    o_orderpriority AS exclusion_reason
  FROM outages)"""


AREA_RAW = FLEET_RAW.replace("l_suppkey AS site_id", "l_suppkey % 5 AS site_id", 1)

# A forecast of many thousand years is given as days since 1970.
_DAYS = "date_diff('day', DATE '1970-01-01', CAST(forecast_payback_date AS DATE)) AS forecast_epoch_day"
_EPOCH_DAY = f"EXCLUDE (forecast_payback_date), {_DAYS}"


class Oracle:
    """The chain of models for one raw section and its keys."""

    def __init__(self, raw: str, keys: tuple[str, ...] = ()):
        self.raw = raw
        self.keys = keys
        self.k = "".join(f"{key}, " for key in keys)
        self.over = f"PARTITION BY {', '.join(keys)} " if keys else ""

    def on(self, left: str, right: str) -> str:
        return "".join(f"{left}.{key} = {right}.{key} AND " for key in self.keys)

    def group(self, *more: str) -> str:
        names = [*self.keys, *more]
        return f" GROUP BY {', '.join(names)}" if names else ""

    def select(self, text: str, *sections: str) -> str:
        return "WITH " + ",\n".join([self.raw, *sections]) + "\n" + text

    @property
    def typed(self) -> str:
        values = ", ".join(f"CAST({name} AS DOUBLE) AS {name}" for name in VALUES)
        rates = ", ".join(f"CAST({name} AS DOUBLE) AS {name}" for name in ("off_peak_rate", "peak_rate", "export_rate"))
        return f"""readings AS (SELECT {self.k}CAST(date || ' ' || hour AS TIMESTAMP) AS reading_datetime, {values} FROM raw),
tariffs AS (SELECT {self.k}CAST(start_date AS DATE) AS start_date, CAST(end_date AS DATE) AS end_date,
  CAST(date_part('hour', CAST(off_peak_start_hour AS TIME)) AS INTEGER) AS off_peak_start_hour,
  CAST(date_part('hour', CAST(off_peak_end_hour AS TIME)) AS INTEGER) AS off_peak_end_hour, {rates} FROM raw_tariffs),
exclusions AS (SELECT {self.k}exclusion_reason, CAST(start_date || ' ' || start_time AS TIMESTAMP) AS start_datetime,
  CAST(end_date || ' ' || end_time AS TIMESTAMP) AS end_datetime FROM raw_exclusions)"""

    @property
    def kept(self) -> str:
        return f"""kept AS (SELECT * FROM readings r WHERE NOT EXISTS (SELECT 1 FROM exclusions x
  WHERE {self.on('x', 'r')}r.reading_datetime BETWEEN x.start_datetime AND x.end_datetime))"""

    def priced(self, source: str = "kept") -> str:
        return f"""priced AS (SELECT r.*, t.off_peak_rate, t.peak_rate, t.export_rate, t.off_peak_start_hour, t.off_peak_end_hour
  FROM {source} r JOIN tariffs t ON {self.on('t', 'r')}CAST(r.reading_datetime AS DATE) BETWEEN t.start_date AND t.end_date)"""

    flagged = """cleaned AS (SELECT * EXCLUDE (off_peak_start_hour, off_peak_end_hour),
  coalesce(hour(reading_datetime) BETWEEN off_peak_start_hour AND off_peak_end_hour, false) AS is_off_peak FROM priced)"""

    @property
    def valued(self) -> str:
        return f"""amounts AS (SELECT *,
    CASE WHEN is_off_peak THEN 0.0::DOUBLE WHEN grid > 0 THEN home - grid ELSE home END AS kw_saved,
    CASE WHEN grid < 0 THEN -grid ELSE 0.0::DOUBLE END AS kw_exported,
    CASE WHEN is_off_peak AND battery > 0 THEN -battery * off_peak_rate ELSE 0.0::DOUBLE END AS charged
  FROM cleaned),
costs AS (SELECT {self.k}reading_datetime, grid, solar, battery, home, off_peak_rate, peak_rate, export_rate, is_off_peak,
    kw_saved, kw_exported, kw_exported * export_rate AS export_income, kw_saved * peak_rate + charged AS saving,
    kw_saved * peak_rate + kw_exported * export_rate + charged AS total_saving
  FROM amounts)"""

    @property
    def chain(self) -> list[str]:
        return [self.typed, self.kept, self.priced(), self.flagged]

    @property
    def cost_chain(self) -> list[str]:
        return [*self.chain, self.valued]

    def sums(self, by: str = "", name: str = "") -> str:
        key = f"{by} AS {name}, " if by else ""
        sums = ", ".join(f"CAST(sum(CAST({m} AS DECIMAL(18,6))) AS DOUBLE) AS {m}" for m in MEASURES)
        return f"SELECT {self.k}{key}{sums} FROM costs{self.group(*([by] if by else []))}"

    @property
    def daily(self) -> str:
        return self.sums("date_trunc('day', reading_datetime)", "reading_date")

    @property
    def monthly(self) -> str:
        return self.sums("date_trunc('month', reading_datetime)", "reading_month")

    @property
    def payback(self) -> str:
        return f"""daily AS ({self.daily}),
running AS (SELECT {self.k}reading_date, total_saving,
    CAST(sum(CAST(total_saving AS DECIMAL(28,6))) OVER ({self.over}ORDER BY reading_date) AS DOUBLE) AS cumulative_saving,
    row_number() OVER ({self.over}ORDER BY reading_date) AS day_number,
    {INSTALLATION_COST} AS installation_cost
  FROM daily),
averaged AS (SELECT *, cumulative_saving / day_number AS average_daily_saving,
    cumulative_saving / installation_cost * 100 AS payback_percentage FROM running),
rounded AS (SELECT *, TRY_CAST(installation_cost / nullif(average_daily_saving, 0) AS INTEGER) AS days_to_payback FROM averaged),
development AS (SELECT {self.k}reading_date, total_saving, cumulative_saving, day_number, installation_cost, payback_percentage,
    days_to_payback, average_daily_saving, reading_date + to_days(days_to_payback) AS forecast_payback_date FROM rounded)"""

    @property
    def latest(self) -> str:
        return f"SELECT {self.k}max(date_trunc('day', reading_datetime)) AS data_date FROM cleaned{self.group()}"

    @property
    def generation(self) -> str:
        total = "CAST(sum(CAST(solar AS DECIMAL(18,6))) AS DOUBLE)"
        return f"""SELECT {self.k}{total} AS total_solar_generation, {total} / count(*) AS average_daily_solar_generation
FROM cleaned{self.group()}"""

    @property
    def heat(self) -> dict[str, str]:
        total = "CAST(sum(CAST(solar AS DECIMAL(18,6))) AS DOUBLE)"
        text = "SELECT {k}CAST(date_trunc('{unit}', reading_datetime) AS DATE) AS {unit}, CAST(hour(reading_datetime) AS INTEGER) AS hour, {value} AS solar FROM cleaned GROUP BY ALL"
        return {
            "day": text.format(k=self.k, unit="day", value=total),
            "month": text.format(k=self.k, unit="month", value=total),
            "month_avg": text.format(k=self.k, unit="month", value=f"{total} / nullif(count(solar), 0)"),
        }

    def models(self, suffix: str = "") -> dict[str, str]:
        """Oracles of the intermediate models and the marts, by query name."""
        heat = self.heat
        development = f"SELECT * {_EPOCH_DAY} FROM development" if self.keys else "SELECT * FROM development"
        current = f"""SELECT {self.k}reading_date AS data_date, payback_percentage, day_number, days_to_payback,
  average_daily_saving, forecast_payback_date
FROM development QUALIFY reading_date = max(reading_date) OVER ({self.over.strip()})"""
        found = {
            "solar_cleaned": self.select("SELECT * FROM cleaned", *self.chain),
            "cost_savings": self.select("SELECT * FROM costs", *self.cost_chain),
            "daily_savings": self.select(self.daily, *self.cost_chain),
            "monthly_savings": self.select(self.monthly, *self.cost_chain),
            "total_savings": self.select(self.sums(), *self.cost_chain),
            "payback_forecast_development": self.select(development, *self.cost_chain, self.payback),
            "payback_forecast_current": self.select(current, *self.cost_chain, self.payback),
            "total_solar_generation": self.select(self.generation, *self.chain),
            "data_date": self.select(self.latest, *self.chain),
            "hourly_generation_by_day": self.select(heat["day"], *self.chain),
            "hourly_generation_by_month": self.select(heat["month"], *self.chain),
            "hourly_generation_by_month_avg": self.select(heat["month_avg"], *self.chain),
        }
        return {name + suffix: text for name, text in found.items()}


ONE = Oracle(ONE_RAW)
FLEET = Oracle(FLEET_RAW, ("site_id",))

_SERVED = "reading_date, payback_percentage, day_number, days_to_payback, average_daily_saving"
_PARSED = "CAST(date AS DATE) AS date, hour, " + ", ".join(f"CAST({v} AS DOUBLE) AS {v}" for v in VALUES)


def not_null_text(relation: str, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{relation}' AS relation, '{name}' AS \"column\", 'not_null' AS test, count(*) FILTER ({name} IS NULL) AS failures FROM {source}"
        for name in NOT_NULL[relation]
    )


def oracle_sql() -> dict[str, str]:
    found = {**ONE.models(), **FLEET.models("_by_site")}

    # Projections, casts and single joins
    found["stg_readings_by_site"] = FLEET.select("SELECT site_id, date, hour, grid, solar, battery, home FROM raw")
    found["stg_tariffs_by_site"] = FLEET.select(
        "SELECT site_id, start_date, end_date, off_peak_start_hour, off_peak_end_hour, off_peak_rate, peak_rate, export_rate FROM raw_tariffs"
    )
    found["stg_exclusions_by_site"] = FLEET.select("SELECT * FROM raw_exclusions")
    found["stg_readings"] = ONE.select("SELECT * FROM raw")
    found["typed_readings"] = ONE.select("SELECT * FROM readings", ONE.typed)
    found["int_tariffs_by_site"] = FLEET.select("SELECT * FROM tariffs", FLEET.typed)
    found["int_exclusions_by_site"] = FLEET.select("SELECT * FROM exclusions", FLEET.typed)
    removed = "SELECT * FROM kept"
    found["excluded_readings_removed"] = ONE.select(removed, ONE.typed, ONE.kept)
    found["excluded_readings_removed_by_site"] = FLEET.select(removed, FLEET.typed, FLEET.kept)
    for name in ("tariff_range_join", "tariff_day_join"):
        found[name] = ONE.select("SELECT * FROM priced", ONE.typed, ONE.priced("readings"))
        found[f"{name}_by_site"] = FLEET.select("SELECT * FROM priced", FLEET.typed, FLEET.priced("readings"))
    found["off_peak_flag"] = ONE.select("SELECT reading_datetime, is_off_peak FROM cleaned", *ONE.chain)

    # The same results by another plan
    found["solar_cleaned_by_site_shuffled"] = found["solar_cleaned_by_site"]
    found["solar_cleaned_by_site_split"] = found["solar_cleaned_by_site"]
    found["tariffs_in_force_by_day"] = """
WITH days AS (SELECT CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS reading_datetime, count(*) AS lines FROM lineitem GROUP BY 1),
many AS (SELECT CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + CAST(o_custkey % 540 AS INTEGER) AS e,
  o_orderkey % 97 AS off_peak_rate, o_orderkey % 101 AS peak_rate, o_custkey % 103 AS export_rate FROM orders)
SELECT reading_datetime, lines, count(*) AS tariffs, CAST(sum(off_peak_rate) AS BIGINT) AS off_peak_rate,
  CAST(sum(peak_rate) AS BIGINT) AS peak_rate, CAST(sum(export_rate) AS BIGINT) AS export_rate
FROM days JOIN many ON CAST(reading_datetime AS DATE) BETWEEN s AND e GROUP BY 1, 2"""
    for suffix, k in (("", ""), ("_by_site", "site_id, ")):
        levels = (("day", "daily", "reading_date", "NULL::TIMESTAMP"), ("month", "monthly", "NULL::TIMESTAMP", "reading_month"), ("total", "total", "NULL::TIMESTAMP", "NULL::TIMESTAMP"))
        found[f"savings_by_level{suffix}"] = " UNION ALL ".join(
            f"SELECT '{level}' AS level, {k}{date} AS reading_date, {month} AS reading_month, {', '.join(MEASURES)} FROM ({found[f'{mart}_savings{suffix}']})"
            for level, mart, date, month in levels
        ).replace("reading_date AS reading_date, NULL::TIMESTAMP", "reading_date, date_trunc('month', reading_date)")
    found["raw_table_corrected_by_site"] = ONE.select(
        """SELECT * FROM parsed p WHERE NOT EXISTS (SELECT 1 FROM brought b WHERE b.site_id = p.site_id AND b.date = p.date)
UNION ALL SELECT * FROM brought""",
        f"parsed AS (SELECT CAST(left(hour, 2) AS BIGINT) % 2 AS site_id, {_PARSED} FROM raw)",
        """brought AS (SELECT * REPLACE (0.5::DOUBLE AS solar) FROM parsed
  WHERE site_id = 0 AND day(date) IN (7, 21) AND CAST(left(hour, 2) AS INTEGER) < 12)""",
    )
    found["payback_current_join"] = found["payback_forecast_current"]
    found["payback_current_join_by_site"] = found["payback_forecast_current_by_site"]
    found["monthly_from_daily_by_site"] = found["monthly_savings_by_site"]
    found["total_from_daily_by_site"] = found["total_savings_by_site"]
    found["generation_from_daily_by_site"] = found["total_solar_generation_by_site"]

    found["bucketed_generation_by_site"] = found["total_solar_generation_by_site"]
    found["bucketed_daily_savings_by_site"] = found["daily_savings_by_site"]

    # Serving reads of marts built and stored by site
    for name in ("data_date", "daily_savings", "monthly_savings", "total_savings"):
        found[f"served_{name}"] = found[f"{name}_by_site"]
    found["served_payback_forecast"] = found["payback_forecast_current_by_site"]
    found["served_payback_forecast_development"] = FLEET.select(
        f"SELECT site_id, {_SERVED}, {_DAYS} FROM development", *FLEET.cost_chain, FLEET.payback
    )

    # Views read after rows were added, with a tariff that never ends
    endless = [ONE.typed.replace("CAST(end_date AS DATE) AS end_date", "DATE '9999-12-31' AS end_date"), ONE.kept, ONE.priced(), ONE.flagged, ONE.valued]
    found["live_views"] = ONE.select("SELECT * FROM costs", *endless)
    half = FLEET.typed.replace("CAST(end_date || ' ' || end_time AS TIMESTAMP) AS end_datetime", "CAST(start_date || ' ' || start_time AS TIMESTAMP) + INTERVAL 30 MINUTE AS end_datetime")
    found["dense_exclusions"] = FLEET.select(
        "SELECT * FROM readings r WHERE NOT EXISTS (SELECT 1 FROM exclusions x WHERE r.reading_datetime BETWEEN x.start_datetime AND x.end_datetime)", half
    )

    # Options
    for name, by, kind in (("daily", "day", "date"), ("monthly", "month", "month"), ("total", "", "")):
        sums = ", ".join(f"round(sum({m}), 6) + 0.0 AS {m}" for m in MEASURES)
        key = f"date_trunc('{by}', reading_datetime) AS reading_{kind}, " if by else ""
        found[f"{name}_savings_default_by_site"] = FLEET.select(f"SELECT site_id, {key}{sums} FROM costs GROUP BY ALL", *FLEET.cost_chain)
    found["hourly_generation_by_month_default_by_site"] = FLEET.select(
        "SELECT site_id, CAST(date_trunc('month', reading_datetime) AS DATE) AS month, CAST(hour(reading_datetime) AS INTEGER) AS hour, round(sum(solar), 6) + 0.0 AS solar FROM cleaned GROUP BY ALL",
        *FLEET.chain,
    )
    lasting = FLEET.typed.replace("CAST(end_date AS DATE) AS end_date", "coalesce(CAST(end_date AS DATE), DATE '9999-12-31') AS end_date")
    found["tariff_open_ended_by_site"] = FLEET.select("SELECT * FROM priced", lasting, FLEET.priced("readings"))
    between = "hour(reading_datetime) BETWEEN off_peak_start_hour AND off_peak_end_hour"
    wrapped = FLEET.flagged.replace(
        between,
        f"CASE WHEN off_peak_start_hour > off_peak_end_hour THEN hour(reading_datetime) >= off_peak_start_hour OR hour(reading_datetime) <= off_peak_end_hour ELSE {between} END",
    )
    ended = FLEET.flagged.replace(between, "hour(reading_datetime) >= off_peak_start_hour AND hour(reading_datetime) < off_peak_end_hour")
    for name, flagged in (("off_peak_wrapped_by_site", wrapped), ("off_peak_end_exclusive_by_site", ended)):
        found[name] = FLEET.select("SELECT site_id, reading_datetime, is_off_peak FROM cleaned", *FLEET.chain[:3], flagged)
    found["payback_remaining_by_site"] = found["payback_forecast_current_by_site"].replace(
        "TRY_CAST(installation_cost /", "TRY_CAST((installation_cost - cumulative_saving) /"
    )
    found["generation_per_day_by_site"] = FLEET.select(
        """SELECT site_id, CAST(sum(CAST(solar AS DECIMAL(18,6))) AS DOUBLE) AS total_solar_generation,
  CAST(sum(CAST(solar AS DECIMAL(18,6))) AS DOUBLE) / count(DISTINCT date_trunc('day', reading_datetime)) AS average_daily_solar_generation
FROM cleaned GROUP BY site_id""",
        *FLEET.chain,
    )
    found["served_daily_savings_in_order"] = FLEET.select(
        f"SELECT CAST(row_number() OVER (ORDER BY reading_date DESC, site_id) AS INTEGER) AS place, site_id, reading_date FROM ({FLEET.daily})", *FLEET.cost_chain
    )

    for suffix, chain in (("", ONE), ("_by_site", FLEET)):
        found[f"payback_development_in_order{suffix}"] = chain.select(
            f"SELECT CAST(row_number() OVER (ORDER BY reading_date{', site_id' if suffix else ''}) AS INTEGER) AS place, {chain.k}reading_date, day_number FROM development",
            *chain.cost_chain, chain.payback,
        )
    found["readings_in_file_order"] = ONE.select(
        "SELECT CAST(row_number() OVER (ORDER BY date, hour) AS INTEGER) AS place, CAST(date AS DATE) AS date, hour FROM raw"
    )

    # Files, tables and streams: what was written must come back
    for name in ("json_roundtrip", "json_roundtrip_small_arrays", "strict_json_load", "csv_roundtrip", "raw_table_loaded_twice", "raw_table_appended", "streamed_readings", "streamed_first_deliveries", "consolidated_csv", "consolidated_table"):
        found[name] = ONE.select(f"SELECT {_PARSED} FROM raw")
    found["tolerant_json_load"] = FLEET.select(
        f"""SELECT site_id, {_PARSED} FROM raw WHERE site_id % 8 IN (0, 3, 5)
UNION ALL SELECT site_id, {_PARSED.replace("hour,", "NULL AS hour,")} FROM raw WHERE site_id % 8 = 6
UNION ALL SELECT site_id, {_PARSED.replace("CAST(solar AS DOUBLE)", "1.0::DOUBLE")} FROM raw WHERE site_id % 8 = 7"""
    )
    found["loaded_beside_rejects"] = found["tolerant_json_load"]
    found["rejected_entries"] = FLEET.select(
        """SELECT reason, position, count(*) AS rejected FROM (
  SELECT CASE WHEN site_id % 8 = 2 AND hours = 1 THEN 'not an array' ELSE 'malformed' END AS reason, NULL::INTEGER AS position
  FROM days WHERE site_id % 8 IN (1, 2, 4)
  UNION ALL SELECT 'not an object', CAST(p AS INTEGER) FROM days CROSS JOIN range(5) AS t(p) WHERE site_id % 8 = 3)
GROUP BY 1, 2""",
        "days AS (SELECT site_id, date, count(*) AS hours FROM raw GROUP BY 1, 2)",
    )
    found["ingest_stamps"] = ONE.select(
        "SELECT CAST(date AS DATE) AS date, hour, CASE WHEN day(CAST(date AS DATE)) <= 15 THEN '1' ELSE '2' END AS load FROM raw"
    )
    found["json_roundtrip_by_site"] = ONE.select(f"SELECT CAST(substr(hour, 1, 2) AS BIGINT) % 2 AS site_id, {_PARSED} FROM raw")
    found["strict_json_load_by_site"] = ONE.select(f"SELECT {_PARSED} FROM raw")
    found["csv_text_by_site"] = FLEET.select(f"SELECT site_id, {_PARSED} FROM raw")
    found["parquet_roundtrip_by_site"] = FLEET.select(
        f"SELECT site_id, {_PARSED.replace('hour,', 'CAST(' + chr(39) + '1970-01-01 ' + chr(39) + ' || hour AS TIMESTAMP) AS hour,')} FROM raw"
    )
    found["seed_tariffs_csv"] = FLEET.select("SELECT * FROM raw_tariffs")
    found["seed_exclusions_csv"] = FLEET.select("SELECT * FROM raw_exclusions")
    found["streamed_daily_savings"] = found["daily_savings"]
    found["refreshed_forecast_development"] = (
        "SELECT reading_date, payback_percentage, day_number, days_to_payback, average_daily_saving, forecast_payback_date "
        f"FROM ({found['payback_forecast_development']})"
    )
    found["refreshed_monthly_savings"] = found["monthly_savings"]
    found["files_present"] = ONE.select("SELECT DISTINCT CAST(date AS DATE) AS date FROM raw")

    # Calendars
    found["missing_dates"] = """WITH present AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders),
days AS (SELECT CAST(unnest(generate_series(min(date) - INTERVAL 7 DAY, max(date) + INTERVAL 30 DAY, INTERVAL 1 DAY)) AS DATE) AS date FROM present)
SELECT date FROM days WHERE date NOT IN (SELECT date FROM present)"""
    found["dates_to_collect"] = """WITH present AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders),
days AS (SELECT CAST(unnest(generate_series(min(date)::TIMESTAMP, (current_date - 1)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS date FROM present)
SELECT date, row_number() OVER (ORDER BY date DESC) AS place FROM days WHERE date NOT IN (SELECT date FROM present)"""
    by_site = """WITH present AS (SELECT DISTINCT l_suppkey AS site_id, CAST(l_shipdate AS DATE) AS date FROM lineitem),
days AS (SELECT CAST(unnest(generate_series(min(date) - INTERVAL 7 DAY, max(date) + INTERVAL 30 DAY, INTERVAL 1 DAY)) AS DATE) AS date FROM present),
sites AS (SELECT DISTINCT site_id FROM present),
missing AS (SELECT site_id, date FROM sites CROSS JOIN days EXCEPT SELECT site_id, date FROM present)
"""
    found["missing_dates_by_site"] = by_site + "SELECT * FROM missing"
    found["newest_missing_date_by_site"] = by_site + "SELECT site_id, max(date) AS date FROM missing GROUP BY site_id"
    skeleton = """, grid_hours AS (SELECT {k}date, strftime(TIMESTAMP '2000-01-01' + to_hours(CAST(h AS INTEGER)), '%H:%M') AS hour
  FROM (SELECT DISTINCT {k}date FROM raw) CROSS JOIN range(24) AS t(h))
SELECT {k}CAST(date AS DATE) AS date, hour, {values} FROM grid_hours LEFT JOIN raw USING ({k}date, hour)"""
    values = ", ".join(f"CAST({v} AS DOUBLE) AS {v}" for v in VALUES)
    found["hour_skeleton"] = "WITH " + ONE_RAW + skeleton.format(k="", values=values)
    # Tooltips without tokens keep their hour; a reading without a solar value had no tooltip.
    tooltip = "raw AS (SELECT * REPLACE (CASE WHEN solar IS NOT NULL THEN battery END AS battery, CASE WHEN solar IS NOT NULL THEN home END AS home) FROM read)"
    renamed = ONE_RAW.replace("raw AS (SELECT", "read AS (SELECT").replace("raw_tariffs(", tooltip + ",\nraw_tariffs(", 1)
    span = ", span AS (SELECT min(CAST(date AS DATE)) AS a, max(CAST(date AS DATE)) AS z FROM raw)"
    found["collected_days"] = (
        "WITH " + renamed + span + """, grid_hours AS (SELECT strftime(d, '%Y-%m-%d') AS date, strftime(TIMESTAMP '2000-01-01' + to_hours(CAST(h AS INTEGER)), '%H:%M') AS hour
  FROM (SELECT unnest(generate_series(a::TIMESTAMP, z::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM span) CROSS JOIN range(24) AS t(h))
SELECT CAST(date AS DATE) AS date, hour, """ + values + " FROM grid_hours LEFT JOIN raw USING (date, hour)"
    )
    found["collected_days_by_site"] = (
        "WITH " + renamed + span + """, sites(site_id) AS (VALUES (1::BIGINT), (2::BIGINT)),
shown AS (SELECT site_id, raw.* FROM raw, sites, span WHERE site_id = 1 OR CAST(date AS DATE) > a + CAST((z - a) // 2 AS INTEGER)),
grid_hours AS (SELECT site_id, strftime(d, '%Y-%m-%d') AS date, strftime(TIMESTAMP '2000-01-01' + to_hours(CAST(h AS INTEGER)), '%H:%M') AS hour
  FROM (SELECT unnest(generate_series(a::TIMESTAMP, z::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM span) CROSS JOIN range(24) AS t(h) CROSS JOIN sites)
SELECT site_id, CAST(date AS DATE) AS date, hour, """ + values + " FROM grid_hours LEFT JOIN shown USING (site_id, date, hour)"
    )
    found["readings_from_tooltips_by_site"] = "WITH " + AREA_RAW + skeleton.format(k="site_id, ", values=values)
    found["hour_skeleton_by_site"] = "WITH " + AREA_RAW + skeleton.format(k="site_id, ", values=values)

    # Checks
    found["dq_not_null"] = FLEET.select(
        " UNION ALL ".join(
            not_null_text(relation, source)
            for relation, source in (
                ("raw_solar_data", "raw"),
                ("raw_tariffs", "raw_tariffs"),
                ("raw_exclusions", "raw_exclusions"),
                ("int_admin_tariffs", "tariffs"),
                ("int_admin_exclusions", "exclusions"),
                ("int_finance_cost_savings", "costs"),
                ("data_date", "latest"),
            )
        ),
        *FLEET.cost_chain,
        f"latest AS ({FLEET.latest})",
    )
    repeated = "SELECT 'raw_tariffs' AS relation, 'start_date' AS \"column\", 'unique' AS test, count(*) AS failures FROM (SELECT 1 FROM raw_tariffs GROUP BY {k}start_date HAVING count(*) > 1)"
    found["dq_unique"] = FLEET.select(repeated.format(k=""))
    found["dq_unique_by_site"] = FLEET.select(repeated.format(k="site_id, "))

    # Parsers over columns
    found["tolerant_float"] = """WITH texts AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber
    WHEN 1 THEN CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) WHEN 2 THEN ' ' || CAST(CAST(l_tax AS DECIMAL(18,2)) AS VARCHAR) || ' '
    WHEN 3 THEN CASE WHEN l_orderkey % 2 = 0 THEN '' ELSE '  ' END WHEN 4 THEN 'x' || CAST(CAST(l_tax AS DECIMAL(18,2)) AS VARCHAR)
    WHEN 5 THEN CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) || 'd' WHEN 6 THEN '1_' || CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) || 'e1' END AS text
  FROM lineitem)
SELECT l_orderkey, l_linenumber, text,
  CASE WHEN regexp_full_match(trim(text), '[+-]?[0-9]+(_[0-9]+)*([.][0-9]+)?(e[0-9]+)?') THEN CAST(replace(trim(text), '_', '') AS DOUBLE) END AS value
FROM texts"""
    found["tolerant_hour"] = """WITH texts AS (SELECT o_orderkey, o_orderkey % 24 AS h, CASE o_orderkey % 6
    WHEN 0 THEN lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':00' WHEN 1 THEN CAST(o_orderkey % 24 AS VARCHAR) || ':5'
    WHEN 2 THEN CAST(24 + o_orderkey % 9 AS VARCHAR) || ':00' WHEN 3 THEN o_orderpriority WHEN 4 THEN '07:' || CAST(o_orderkey % 90 AS VARCHAR) END AS text
  FROM orders)
SELECT o_orderkey, text, CASE o_orderkey % 6 WHEN 0 THEN text WHEN 1 THEN lpad(CAST(h AS VARCHAR), 2, '0') || ':05'
  WHEN 4 THEN CASE WHEN o_orderkey % 90 < 60 THEN '07:' || lpad(CAST(o_orderkey % 90 AS VARCHAR), 2, '0') END END AS hour
FROM texts"""
    found["iso_date"] = """WITH texts AS (SELECT o_orderkey, o_orderdate, CASE o_orderkey % 6
    WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y%m%d') WHEN 2 THEN strftime(o_orderdate, '%G-W%V-%u')
    WHEN 3 THEN strftime(o_orderdate, '%Y-%m') || '-31' WHEN 4 THEN strftime(o_orderdate, '%d/%m/%Y') END AS text
  FROM orders)
SELECT o_orderkey, text, CASE WHEN o_orderkey % 6 IN (0, 1, 2) THEN CAST(o_orderdate AS DATE)
  WHEN o_orderkey % 6 = 3 THEN TRY_CAST(text AS DATE) END AS date
FROM texts"""
    found["multi_format_date"] = """WITH texts AS (SELECT o_orderkey, o_orderdate, CASE o_orderkey % 8
    WHEN 0 THEN strftime(o_orderdate, '%d | %m %Y') WHEN 1 THEN strftime(o_orderdate, '%d| %m %Y') WHEN 2 THEN strftime(o_orderdate, '%d|%m %Y')
    WHEN 3 THEN strftime(o_orderdate, '%d |%m %Y') WHEN 4 THEN strftime(o_orderdate, '%d/%m %Y') WHEN 5 THEN strftime(o_orderdate, '%d %m %Y')
    WHEN 6 THEN strftime(o_orderdate, '31 | %m %Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS text
  FROM orders)
SELECT o_orderkey, text, CASE WHEN o_orderkey % 8 < 6 THEN CAST(o_orderdate AS DATE)
  WHEN o_orderkey % 8 = 6 THEN TRY_CAST(strftime(o_orderdate, '%Y-%m-31') AS DATE) END AS date
FROM texts"""
    found["label_tokens"] = FLEET.select(
        """SELECT site_id, date, max(hour) AS hour, max(grid) AS grid, max(solar) AS solar, max(battery) AS battery, max(home) AS home
FROM (
  SELECT site_id, date, h,
    CASE WHEN label = 'hour' THEN last_value END AS hour, CASE WHEN label = 'Grd : ' THEN last_value END AS grid,
    CASE WHEN label = 'Sol : ' THEN last_value END AS solar, CASE WHEN label IN ('Bat : ', 'BATTERY : ') THEN last_value END AS battery,
    CASE WHEN label = 'Hom : ' THEN last_value END AS home
  FROM (SELECT site_id, date, h, label, arg_max(token, place) AS last_value FROM labelled
    WHERE token NOT LIKE '% : ' GROUP BY site_id, date, h, label))
GROUP BY site_id, date, h""",
        """tokens AS (SELECT site_id, date, hour AS h, list_filter([hour, 'Grd : ', grid, 'Sol : ', solar]
    || CASE WHEN site_id % 4 = 1 THEN ['Wnd : ', '7.70'] ELSE [] END
    || CASE WHEN site_id % 4 = 3 THEN ['BATTERY : ', battery] ELSE ['Bat : ', battery] END || ['Hom : ', home]
    || CASE WHEN site_id % 4 = 2 THEN ['Grd : ', '9.99'] ELSE [] END, lambda t: t IS NOT NULL) AS tokens FROM raw)""",
        """placed AS (SELECT site_id, date, h, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS place FROM tokens)""",
        """labelled AS (SELECT *, coalesce(last_value(CASE WHEN token LIKE '% : ' THEN token END IGNORE NULLS)
    OVER (PARTITION BY site_id, date, h ORDER BY place), 'hour') AS label FROM placed)""",
    )
    return found
