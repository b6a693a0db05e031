"""DuckDB text of the same queries, written against the tables alone."""

from __future__ import annotations

from riskweave.settings import (
    BLACKLISTED_MERCHANTS, CATEGORY_RISK, COUNTRY_RISK, E2E_LATENCY_BOUNDS,
    JOB_CATEGORY_RISK, JOB_COUNTRY_RISK, PROCESSING_LATENCY_BOUNDS, SCORE_BOUNDS,
)

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
LAST_BATCH = "TIMESTAMP '2024-01-25 00:00:00'"
A_USER = "'USER_00007'"


def _table(name: str, values: dict, extra: tuple = ()) -> str:
    rows = [f"({i}, '{k}', {v}::DOUBLE)" for i, (k, v) in enumerate(values.items())]
    rows += [f"({len(values) + i}, {k}, NULL)" for i, k in enumerate(extra)]
    return f"{name}(idx, name, risk) AS (VALUES {', '.join(rows)})"


BASE = f"""
{_table('c', COUNTRY_RISK)}, {_table('m', CATEGORY_RISK)},
{_table('jc', JOB_COUNTRY_RISK)}, {_table('jm', JOB_CATEGORY_RISK)},
cn(idx, name) AS (SELECT idx, name FROM c UNION ALL VALUES (27, 'ZZ'), (28, NULL)),
mn(idx, name) AS (SELECT idx, name FROM m UNION ALL VALUES (18, 'florist'), (19, NULL)),
txn AS (
  SELECT 'TXN-' || lpad(CAST(e.event_id AS VARCHAR), 8, '0') AS transaction_id,
    'USER_' || lpad(CAST(e.user_id AS VARCHAR), 5, '0') AS user_id,
    CASE WHEN e.event_id % 20 = 3
         THEN least(1000 + round(e.value * 90::DOUBLE, 2), 10000::DOUBLE)
         ELSE least(round(e.value * 8::DOUBLE, 2), 2000::DOUBLE) END AS amount,
    'MERCHANT_' || CASE WHEN e.event_id % 100 = 3 THEN '999'
         ELSE lpad(CAST((e.event_id * 13) % 100 AS VARCHAR), 3, '0') END AS merchant_id,
    CASE WHEN e.event_id % 20 = 3 THEN
           CASE (e.event_id - 3) % 80 WHEN 0 THEN 'crypto' WHEN 20 THEN 'gambling'
                WHEN 40 THEN 'jewelry' ELSE 'wire_transfer' END
         ELSE mn.name END AS merchant_category,
    CASE WHEN e.event_id % 20 = 3 THEN
           CASE e.event_id % 3 WHEN 0 THEN 'NG' WHEN 1 THEN 'UA' ELSE 'UNKNOWN' END
         ELSE cn.name END AS country,
    CASE WHEN e.event_id % 97 = 0 THEN NULL
         WHEN e.event_id % 20 = 3 THEN e.event_id % 200 <> 3
         ELSE e.event_type IN ('click', 'view') END AS is_online,
    CAST(hour(e.ts) AS INTEGER) AS hour_of_day,
    CASE WHEN k.copy = 1 THEN 'duplicate' WHEN e.event_id % 20 = 3 THEN 'fraud'
         WHEN e.event_id % 50 = 1 THEN 'late' ELSE 'normal' END AS label,
    e.ts AS event_ts,
    e.ts + INTERVAL '1' SECOND * CAST(CASE WHEN k.copy = 1 THEN 400
         WHEN e.event_id % 50 = 1 THEN 60 + e.event_id % 241
         ELSE e.event_id % 3 END AS INTEGER) AS proc_ts,
    e.event_id AS event_id
  FROM events e
  JOIN (VALUES (0), (1)) k(copy) ON k.copy = 0 OR e.event_id % 100 = 2
  LEFT JOIN cn ON cn.idx = (e.event_id * 7 + e.user_id) % 29
  LEFT JOIN mn ON mn.idx = (e.event_id * 5 + e.user_id * 3) % 20),
ded AS (
  SELECT * FROM txn
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY proc_ts) = 1),
enr AS (
  SELECT d.*, coalesce(c.risk, 0.9::DOUBLE) AS country_risk,
         coalesce(m.risk, 0.5::DOUBLE) AS merchant_risk
  FROM ded d LEFT JOIN c ON c.name = d.country LEFT JOIN m ON m.name = d.merchant_category)
"""

AMOUNT = """CASE WHEN amount > 5000 THEN 0.2::DOUBLE
                 WHEN amount > 1000 THEN 0.1::DOUBLE ELSE 0::DOUBLE END"""


def _if(condition: str, weight: float) -> str:
    return f"CASE WHEN {condition} THEN {weight}::DOUBLE ELSE 0::DOUBLE END"


def _night(weight: float) -> str:
    return _if("hour_of_day BETWEEN 0 AND 5", weight)


def _total(country: str, category: str, *terms: str) -> str:
    parts = [f"{country} * 0.25::DOUBLE", f"{category} * 0.20::DOUBLE", *terms]
    return f"least(1::DOUBLE, greatest(0::DOUBLE, {' + '.join(parts)}))"


STREAM_SCORE = _total("country_risk", "merchant_risk", AMOUNT, _if("is_online", 0.1),
                      _night(0.1), _if("amount > 1000", 0.15))
BATCH_SCORE = _total(
    "country_risk", "merchant_risk",
    "CASE WHEN z > 3 THEN 0.2::DOUBLE WHEN z > 2 THEN 0.1::DOUBLE ELSE 0::DOUBLE END",
    _if("velocity_count > 5", 0.15), _if("velocity_amount > 5000", 0.1),
    _if("is_online", 0.05), _night(0.05))


def _history(seconds: int) -> str:
    return f"""
    hist AS (
      SELECT e.*, CAST(count(*) OVER w AS BIGINT) AS velocity_count,
             CAST(sum(CAST(amount AS DECIMAL(24,6))) OVER w AS DOUBLE) AS velocity_amount,
             avg(amount) OVER (PARTITION BY user_id) AS mean,
             stddev_samp(amount) OVER (PARTITION BY user_id) AS dev,
             lag(event_ts) OVER (PARTITION BY user_id ORDER BY event_ts, transaction_id)
               AS prev_ts
      FROM enr e
      WINDOW w AS (PARTITION BY user_id ORDER BY CAST(floor(epoch(event_ts)) AS BIGINT)
                   RANGE BETWEEN {seconds} PRECEDING AND CURRENT ROW)),
    feat AS (
      SELECT *, CASE WHEN dev > 0 THEN (amount - mean) / dev ELSE 0::DOUBLE END AS z,
             coalesce(CAST(floor(epoch(event_ts)) AS BIGINT)
                      - CAST(floor(epoch(prev_ts)) AS BIGINT), 999999) AS gap
      FROM hist),
    sb AS (SELECT *, {BATCH_SCORE} AS score, {BATCH_SCORE} >= 0.7::DOUBLE AS hit FROM feat)"""


LIVE = f"""
ss AS (SELECT *, {STREAM_SCORE} AS score, {STREAM_SCORE} >= 0.7::DOUBLE AS hit FROM enr)"""

FAULTS = """
msg AS (
  SELECT *, CASE event_id % 40 WHEN 7 THEN 'malformed' WHEN 17 THEN 'malformed'
              WHEN 27 THEN 'missing merchant_id' WHEN 37 THEN 'bad event_time' END AS fault,
         CASE WHEN event_id % 40 IN (7) THEN NULL ELSE proc_ts END AS seen_ts
  FROM txn),
chk AS (
  SELECT *, CASE WHEN fault IS NOT NULL THEN fault
                 WHEN amount <= 0 THEN 'amount not positive' END AS reason FROM msg)"""


def _sql(select: str, *ctes: str) -> str:
    return f"WITH {', '.join([BASE, *ctes])} {select}"


def ts(column: str, micros: bool = False) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S{'.%f' if micros else ''}')"


N = "CAST(count(*) AS BIGINT)"


def _n(condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT)"


def _share(part: str, whole: str, digits: int = 9) -> str:
    return f"round({part}::DOUBLE / greatest(1, {whole}), {digits})"


def _scored(table: str, *ctes: str) -> str:
    return _sql(f"SELECT transaction_id, round(score, 6) AS fraud_score, "
                f"hit AS is_fraud_predicted FROM {table}", *ctes)


def _simple_score(country: str, countries: str = "c", categories: str = "m") -> str:
    score = _total(country, "coalesce(m.risk, 0.5::DOUBLE)", AMOUNT, _if("is_online", 0.1),
                   _night(0.1), _if("label = 'fraud'", 0.15))
    return f"""sc AS (
      SELECT d.*, {score} AS score, {score} >= 0.6::DOUBLE AS hit
      FROM ded d LEFT JOIN {countries} c ON c.name = d.country
      LEFT JOIN {categories} m ON m.name = d.merchant_category)"""


SQL_SCORE = _simple_score("coalesce(c.risk, 0.5::DOUBLE)")

PROFILE = f"""
prof AS (
  SELECT user_id, {N} AS total_transactions, sum(amount) AS total_amount,
    avg(amount) AS avg_amount, stddev_samp(amount) AS stddev_amount,
    min(event_ts) AS first_ts, max(event_ts) AS last_ts,
    CAST(count(DISTINCT country) AS BIGINT) AS unique_countries,
    CAST(count(DISTINCT merchant_id) AS BIGINT) AS unique_merchants,
    {_n('is_online')} AS online_count, {_n("label = 'fraud'")} AS fraud_count,
    list_sort(list(DISTINCT country) FILTER (country IS NOT NULL)) AS countries,
    list_sort(list(DISTINCT merchant_category) FILTER (merchant_category IS NOT NULL))
      AS categories,
    CAST(date_diff('day', CAST(min(event_ts) AS DATE), CAST({AS_OF} AS DATE)) AS INTEGER)
      AS age
  FROM ded GROUP BY user_id)"""


def _period(keys: str, group: str, table: str = "sb") -> str:
    return f"""SELECT {keys}, {N} AS total_transactions,
      round(sum(amount), 4) AS total_amount, {_n('hit')} AS fraud_count,
      round(avg(score), 12) AS avg_fraud_score FROM {table} GROUP BY {group}"""


def _country_top(table: str, top: int, country: str = "country") -> str:
    return f"""SELECT {country} AS country, {N} AS total, {_n('hit')} AS fraud_count,
      round(sum(amount), 4) AS total_amount, {_share(_n('hit'), N)} AS fraud_rate
      FROM {table} GROUP BY 1 ORDER BY total DESC, country ASC NULLS LAST LIMIT {top}"""


def _risky_users(table: str, least: int) -> str:
    return f"""SELECT user_id, {N} AS total_transactions, {_n('hit')} AS fraud_count,
      round(sum(amount), 4) AS total_amount, round(avg(score), 12) AS avg_score,
      {_share(_n('hit'), N)} AS fraud_rate
      FROM {table} GROUP BY user_id HAVING count(*) >= {least}
      ORDER BY {_n('hit')}::DOUBLE / count(*) DESC, user_id LIMIT 10"""


def _histogram(table: str, value: str, bounds: tuple, keys: str = "") -> str:
    limits = ", ".join(f"('{float(b)}', {b}::DOUBLE)" for b in bounds)
    group = f"{keys}, " if keys else ""
    return f"""SELECT {group}l.le, {_n('v <= l.bound')} AS cumulative, {N} AS count,
      round(sum(v), 4) AS sum
      FROM (SELECT {group}{value} AS v FROM {table}) t,
           (VALUES {limits}, ('+Inf', 'inf'::DOUBLE)) l(le, bound)
      GROUP BY {group}l.le"""


def _quantile(q: float) -> str:
    whens, low = [], 0.0
    for i, upper in enumerate(PROCESSING_LATENCY_BOUNDS):
        below = f"b{i - 1}" if i else "0"
        whens.append(
            f"WHEN b{i} >= n * {q}::DOUBLE THEN {low}::DOUBLE + ({upper}::DOUBLE - "
            f"{low}::DOUBLE) * (n * {q}::DOUBLE - {below}) / nullif(b{i} - {below}, 0)")
        low = upper
    return f"CASE {' '.join(whens)} ELSE {low}::DOUBLE END"


def _closed_windows(table: str, slide: str, keys: str, measures: str, offsets: str) -> str:
    """Windows the watermark (last event minus 30 s) has passed."""
    group = f", {keys}" if keys else ""
    return f"""SELECT {ts('ws')} AS window_start, {ts("ws + INTERVAL 1 MINUTE")} AS window_end
      {group}, {N} AS n, round(sum(amount), 4) AS total_amount{measures}
      FROM (SELECT t.*, time_bucket(INTERVAL '{slide}', event_ts)
                   - k.i * INTERVAL '{slide}' AS ws
            FROM {table} t, (VALUES {offsets}) k(i))
      GROUP BY ws{group}
      HAVING ws + INTERVAL 1 MINUTE <= (SELECT max(event_ts) FROM txn) - INTERVAL 30 SECOND"""


# Whether the watermark has passed the minute of a row.
MINUTE_CLOSED = """date_trunc('minute', event_ts) + INTERVAL 1 MINUTE
  <= (SELECT max(event_ts) FROM txn) - INTERVAL 30 SECOND"""

RAW_STREAM = f"""
raws AS (
  SELECT t.*, coalesce(c.risk, 0.9::DOUBLE) AS country_risk,
         coalesce(m.risk, 0.5::DOUBLE) AS merchant_risk
  FROM txn t LEFT JOIN c ON c.name = t.country LEFT JOIN m ON m.name = t.merchant_category
  WHERE t.amount > 0),
rs AS (SELECT *, {STREAM_SCORE} AS score, {STREAM_SCORE} >= 0.7::DOUBLE AS hit FROM raws)"""

MERGED = f"""
mrg AS (
  SELECT transaction_id, user_id, amount, score, event_ts, 'batch' AS source, hit
  FROM sb WHERE event_ts < {LAST_BATCH}
  UNION ALL
  SELECT transaction_id, user_id, amount, score, event_ts, 'realtime', hit
  FROM ss WHERE event_ts >= {LAST_BATCH})"""

LAYERS = """
lay AS (SELECT 'batch' AS layer, country, hit FROM sb
        UNION ALL SELECT 'stream', country, hit FROM ss)"""

DAY = _history(86400)
SHORT = _history(300)


def _as_of(table: str) -> str:
    """The table with the risks of the version that holds at the event's time."""
    def cases(column: str, values: dict, default: float) -> str:
        whens = " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in values.items())
        return f"CASE {column} {whens} ELSE {default}::DOUBLE END"

    after = "event_ts >= TIMESTAMP '2024-01-16 12:00:00'"
    country = cases("country", {"US": 0.5, "NG": 0.1, "UA": 0.95, "DE": 0.3}, 0.9)
    category = cases("merchant_category", {"grocery": 0.9, "crypto": 0.2, "travel": 0.6}, 0.5)
    return f"""(SELECT * REPLACE (
      CASE WHEN {after} THEN {country} ELSE country_risk END AS country_risk,
      CASE WHEN {after} THEN {category} ELSE merchant_risk END AS merchant_risk) FROM {table})"""
RECENT = f"proc_ts >= {AS_OF} - INTERVAL 1 HOUR"


def _merged_select(extra: str, limit: int) -> str:
    return f"""SELECT transaction_id, user_id, amount, source, round(score, 6) AS fraud_score,
      {ts('event_ts', True)} AS event_at FROM mrg
      WHERE hit AND event_ts >= TIMESTAMP '2024-01-01 00:00:00' AND event_ts <= {AS_OF} {extra}
      ORDER BY event_ts DESC, transaction_id LIMIT {limit}"""


def _uses(name: str, table: str, column: str) -> str:
    return f"""SELECT '{name}' AS risk_table, r.name AS entry, r.risk,
      CAST(count(d.transaction_id) AS BIGINT) AS transactions
      FROM {table} r LEFT JOIN ded d ON d.{column} = r.name GROUP BY r.name, r.risk"""


def _view_size(name: str, source: str, where: str = "true") -> str:
    return (f"SELECT '{name}' AS view, {N} AS rows, {ts(LAST_BATCH)} AS last_batch "
            f"FROM {source} WHERE {where}")


def all_oracles() -> dict[str, str]:
    out: dict[str, str] = {}
    out["scan_master"] = _sql(f"""SELECT transaction_id, user_id, amount, country, is_online,
        hour_of_day, {ts('event_ts', True)} AS event_at, {ts('proc_ts', True)} AS arrived_at,
        label, CAST(year(event_ts) AS INTEGER) AS year, CAST(month(event_ts) AS INTEGER) AS month,
        CAST(day(event_ts) AS INTEGER) AS day FROM ded""")
    out["stream_ingest"] = _sql(f"""SELECT transaction_id, user_id, amount, merchant_category,
        country, is_online, {ts('event_ts', True)} AS event_at,
        {ts('proc_ts', True)} AS arrived_at FROM txn WHERE amount > 0""")
    out["risk_tables"] = _sql(" UNION ALL ".join([
        _uses("country", "c", "country"), _uses("category", "m", "merchant_category"),
        _uses("job_country", "jc", "country"),
        _uses("job_category", "jm", "merchant_category")]))
    out["alerts_from_partitioned"] = _sql(
        "SELECT transaction_id, amount, round(score, 6) AS fraud_score FROM sc WHERE hit",
        SQL_SCORE)
    out["landing_partitions"] = _sql(f"""SELECT CAST(year(event_ts) AS INTEGER) AS year,
        CAST(month(event_ts) AS INTEGER) AS month, CAST(day(event_ts) AS INTEGER) AS day,
        {N} AS n FROM txn GROUP BY 1, 2, 3""")
    out["kafka_envelope"] = _sql(f"""SELECT user_id AS key, transaction_id,
        strftime(proc_ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS sent_at, country FROM txn""")
    out["alert_envelope"] = _sql(
        "SELECT user_id AS key, transaction_id, amount FROM ss WHERE hit", LIVE)
    out["serving_alert_cap"] = _sql("""SELECT transaction_id, user_id,
        round(score, 6) AS fraud_score FROM sb WHERE hit
        ORDER BY score DESC, event_ts DESC, transaction_id LIMIT 10000""", DAY)
    out["serving_alerts"] = _sql("""SELECT transaction_id, user_id,
        round(score, 6) AS fraud_score FROM sb WHERE hit""", DAY)
    out["metadata_latest"] = _sql(f"""SELECT 'last_batch_timestamp' AS key,
        {ts("date_trunc('day', max(event_ts))")} AS value,
        {ts('arg_max(proc_day, day)')} AS updated_at
        FROM (SELECT date_trunc('day', event_ts) AS day, max(event_ts) AS event_ts,
                     max(proc_ts) AS proc_day FROM ded GROUP BY 1)
        UNION ALL SELECT 'last_arrival', {ts('max(proc_ts)')}, {ts('max(proc_ts)')} FROM ded""")

    out["parse_times"] = _sql(f"""SELECT transaction_id, label, {ts('event_ts', True)} AS event_at,
        {ts('proc_ts', True)} AS arrived_at, CAST(floor(epoch(proc_ts)) AS BIGINT)
        - CAST(floor(epoch(event_ts)) AS BIGINT) AS delay_seconds FROM txn""")
    out["parse_json_props"] = """SELECT event_id,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"""
    out["time_parts"] = _sql("""SELECT transaction_id, label,
        CAST(year(event_ts) AS INTEGER) AS year, CAST(month(event_ts) AS INTEGER) AS month,
        CAST(day(event_ts) AS INTEGER) AS day, CAST(hour(event_ts) AS INTEGER) AS hour
        FROM txn""")
    out["risk_enriched"] = _sql("""SELECT transaction_id, country, merchant_category,
        country_risk, merchant_risk FROM enr""")
    out["amount_flags"] = _sql("""SELECT transaction_id, amount, amount > 1000 AS is_high_amount,
        amount > 5000 AS is_very_high_amount FROM ded""")
    out["fraud_results"] = _sql(f"""SELECT transaction_id, user_id, amount, country,
        merchant_category, round(score, 6) AS fraud_score, hit AS is_fraud_predicted,
        {ts('event_ts', True)} AS event_timestamp, country_risk, merchant_risk,
        velocity_count, round(z, 4) AS amount_zscore, {ts(AS_OF)} AS batch_timestamp
        FROM sb""", SHORT)
    alert = f"""SELECT transaction_id, user_id, amount, country, merchant_category,
        round(score, 6) AS fraud_score, hit AS is_fraud_predicted,
        {ts('proc_ts', True)} AS processing_time FROM ss WHERE hit"""
    out["alerts"] = _sql(alert, LIVE)
    out["alert_display"] = _sql("""SELECT
        CASE WHEN length(transaction_id) > 12 THEN substr(transaction_id, 1, 12) || '...'
             ELSE transaction_id END AS transaction_id, user_id,
        '$' || format('{:,.2f}', amount) AS amount, country, merchant_category,
        format('{:,.2f}', round(score * 100, 6)) || '%' AS fraud_score
        FROM ss WHERE hit ORDER BY proc_ts DESC, ss.transaction_id LIMIT 20""", LIVE)

    out["score_stream"] = _scored("ss", LIVE)
    out["score_sql"] = out["score_processor"] = _scored("sc", SQL_SCORE)
    out["score_sql_rescored"] = out["score_sql"]
    out["score_job"] = _scored(
        "sc", _simple_score("coalesce(c.risk, 0.5::DOUBLE)", "jc", "jm"))
    out["score_simple"] = _scored("sc", _simple_score(
        "coalesce(c.risk, CASE WHEN country IS NULL THEN 0.9::DOUBLE ELSE 0.5::DOUBLE END)"))
    out["score_batch"] = _scored("sb", SHORT)
    out["score_batch_86400"] = _scored("sb", DAY)
    scorer = _total("country_risk", "merchant_risk", AMOUNT, _if("is_online", 0.1),
                    _night(0.1), _if("velocity_count > 5", 0.15))
    out["score_scorer"] = _sql(f"""SELECT transaction_id, round({scorer}, 6) AS fraud_score,
        {scorer} >= 0.7::DOUBLE AS is_fraud_predicted, country_risk, merchant_risk,
        CASE WHEN amount > 5000 THEN 1::DOUBLE WHEN amount > 1000 THEN 0.5::DOUBLE
             ELSE 0::DOUBLE END AS amount_risk,
        {_if('is_online', 1)} AS is_online, {_night(1)} AS hour_risk,
        {_if('velocity_count > 5', 1)} AS velocity_risk FROM hist""", DAY)
    out["score_sql_udf"] = _sql(
        "SELECT transaction_id, round(score, 6) AS fraud_score FROM ss", LIVE)
    black = ", ".join(f"'{b}'" for b in BLACKLISTED_MERCHANTS)
    out["blacklist_hits"] = _sql(
        f"SELECT transaction_id, merchant_id FROM ded WHERE merchant_id IN ({black})")
    out["blacklist_clean"] = _sql(
        f"SELECT transaction_id, merchant_id FROM ded WHERE merchant_id NOT IN ({black})")
    out["blacklist_flags"] = _sql(f"""SELECT merchant_id IN ({black}) AS is_blacklisted, {N} AS n,
        round(sum(amount), 4) AS total_amount FROM ded GROUP BY 1""")

    out["dedup_batch"] = _sql(f"""SELECT transaction_id, label,
        {ts('proc_ts', True)} AS arrived_at FROM ded""")
    out["user_profiles"] = _sql(f"""SELECT user_id, total_transactions,
        round(total_amount, 4) AS total_amount, round(avg_amount, 10) AS avg_amount,
        round(stddev_amount, 4) AS stddev_amount, {ts('first_ts', True)} AS first_transaction,
        {ts('last_ts', True)} AS last_transaction, unique_countries, unique_merchants,
        online_count, fraud_count, array_to_string(countries, ',') AS countries_used,
        array_to_string(categories, ',') AS categories_used,
        round(fraud_count::DOUBLE / total_transactions, 9) AS fraud_rate,
        round(online_count::DOUBLE / total_transactions, 9) AS online_rate,
        age AS account_age_days FROM prof""", PROFILE)
    out["user_profile_lookup"] = _sql(f"""SELECT user_id, total_transactions,
        round(avg_amount, 10) AS avg_amount, unique_countries, age AS account_age_days
        FROM prof WHERE user_id = {A_USER}""", PROFILE)
    out["user_features"] = _sql("""SELECT user_id, total_transactions AS transaction_count,
        round(avg_amount, 10) AS avg_amount, round(stddev_amount, 4) AS stddev_amount,
        round(total_amount, 4) AS total_amount, unique_countries, unique_merchants,
        online_count FROM prof""", PROFILE)
    hours = ", ".join(f"{_n(f'hour_of_day = {h}')} AS h{h:02d}" for h in range(24))
    out["hourly_pivot"] = _sql(f"SELECT user_id, {hours} FROM ded GROUP BY user_id")
    out["avg_profile_rate"] = _sql(f"""SELECT {N} AS users,
        round(avg(fraud_count::DOUBLE / total_transactions), 12) AS avg_fraud_rate,
        round(avg(online_count::DOUBLE / total_transactions), 12) AS avg_online_rate
        FROM prof""", PROFILE)
    out["profile_enriched"] = _sql("""SELECT transaction_id, user_id, amount, total_transactions,
        round(avg_amount, 10) AS avg_amount,
        round(fraud_count::DOUBLE / total_transactions, 9) AS fraud_rate
        FROM ded JOIN prof USING (user_id)""", PROFILE)
    out["new_country_for_user"] = _sql(f"""SELECT transaction_id, d.user_id, country,
        country IS NOT NULL AND k.known IS NOT NULL
          AND NOT coalesce(list_contains(k.known, country), false) AS is_new_country
        FROM ded d LEFT JOIN (
          SELECT user_id, coalesce(list(DISTINCT country) FILTER (country IS NOT NULL), [])
            AS known FROM ded WHERE event_ts < {LAST_BATCH} GROUP BY user_id) k
        ON k.user_id = d.user_id WHERE event_ts >= {LAST_BATCH}""")
    out["amount_zscore"] = _sql(
        "SELECT transaction_id, round(z, 4) AS amount_zscore FROM feat", SHORT)
    velocity = """SELECT transaction_id, velocity_count,
        round(velocity_amount, 4) AS velocity_amount FROM hist"""
    out["velocity_300"] = _sql(velocity, SHORT)
    out["velocity_86400"] = _sql(velocity, DAY)
    out["time_since_last"] = _sql(f"""SELECT transaction_id, {ts('prev_ts', True)} AS prev_at,
        gap AS time_since_last FROM feat""", SHORT)

    out["daily_stats"] = _sql(_period(
        ts("date_trunc('day', event_ts)") + " AS date", "1"), DAY)
    out["country_stats"] = _sql(
        f"SELECT *, round(fraud_count::DOUBLE / total_transactions, 9) AS fraud_rate "
        f"FROM ({_period('country', 'country')})", DAY)
    out["period_stats"] = _sql(" UNION ALL ".join(
        _period(f"'{g}' AS grain, " + ts(f"date_trunc('{g}', event_ts)") + " AS period_start",
                "1, 2") for g in ("day", "week", "month")), DAY)
    out["run_summary"] = _sql(f"""SELECT {N} AS total, {_n('hit')} AS fraud_count,
        round(avg(score), 12) AS avg_score, {_share(_n('hit'), N)} AS fraud_rate FROM sc""",
        SQL_SCORE)
    out["fraud_rate_over_time"] = _sql(f"""SELECT strftime(event_ts, '%Y-%m-%d %H:00') AS hour,
        {N} AS total, {_n('hit')} AS fraud_count, round(avg(score), 12) AS avg_score
        FROM ss WHERE event_ts >= {AS_OF} - INTERVAL 24 HOUR GROUP BY 1""", LIVE)
    out["transactions_by_country"] = _sql(_country_top("ss", 20), LIVE)
    out["transactions_by_country_fallback"] = _sql(_country_top("sb", 20), DAY)
    out["by_country"] = _sql(_country_top("ss", 8, "coalesce(country, 'Unknown')"), LIVE)
    out["by_country_15"] = _sql(
        _country_top("(SELECT * FROM ss WHERE hit)", 15), LIVE)
    out["by_country_10"] = _sql(f"""SELECT country, {N} AS count, {_n('hit')} AS fraud FROM ss
        GROUP BY country ORDER BY count DESC, country ASC NULLS LAST LIMIT 10""", LIVE)
    out["country_bubble"] = _sql(f"""SELECT country, total,
        round(total_amount / max(total_amount) OVER () * 50 + 10, 4) AS bubble_size
        FROM ({_country_top('ss', 8, "coalesce(country, 'Unknown')")})""", LIVE)
    out["by_category"] = _sql(f"""SELECT category, total, round(amount, 4) AS amount,
        round(sum(amount) OVER (), 4) AS shown_amount FROM (
          SELECT coalesce(merchant_category, 'Other') AS category, {N} AS total,
                 sum(amount) AS amount
          FROM ss GROUP BY 1 ORDER BY total DESC, category LIMIT 6)""", LIVE)
    out["high_risk_users"] = _sql(_risky_users("ss", 3), LIVE)
    out["high_risk_users_min2"] = _sql(_risky_users("(SELECT * FROM ss WHERE hit)", 2), LIVE)
    out["recent_stats"] = _sql(f"""SELECT {_n(RECENT)} AS recent_total,
        {_n(RECENT + ' AND hit')} AS recent_fraud, {N} AS total, {_n('hit')} AS fraud,
        round(avg(amount), 10) AS avg_amount,
        {_share(_n(RECENT + ' AND hit'), _n(RECENT))} AS recent_fraud_rate,
        {_share(_n('hit'), N)} AS fraud_rate FROM ss""", LIVE)
    out["dashboard_summary"] = _sql(f"""SELECT {N} AS total_transactions,
        {_n('hit')} AS total_fraud, {_share(_n('hit'), N)} AS fraud_rate,
        {_n(RECENT)} AS recent_transactions, {_n(RECENT + ' AND hit')} AS recent_fraud,
        {_share(_n(RECENT + ' AND hit'), _n(RECENT))} AS recent_fraud_rate,
        round(avg(amount), 10) AS avg_amount FROM ss""", LIVE)
    out["hourly_trend"] = _sql(f"""SELECT hour_of_day AS hour, {N} AS total,
        {_n('hit')} AS fraud FROM ss GROUP BY 1""", LIVE)
    out["amount_buckets"] = _sql(f"""SELECT CASE
        WHEN amount >= 0 AND amount < 100 THEN '$0-100'
        WHEN amount >= 100 AND amount < 500 THEN '$100-500'
        WHEN amount >= 500 AND amount < 1000 THEN '$500-1K'
        WHEN amount >= 1000 AND amount < 5000 THEN '$1K-5K'
        WHEN amount >= 5000 AND amount < 10000 THEN '$5K-10K'
        WHEN amount >= 10000 AND amount < 100000 THEN '$10K+' ELSE 'Other' END AS range,
        {N} AS count, {_n('hit')} AS fraud FROM ss GROUP BY 1""", LIVE)
    out["score_histogram"] = _sql(f"""SELECT bin, {N} AS count, bin::DOUBLE / 20 AS bin_start
        FROM (SELECT CAST(least(floor(round(score * 20, 6)), 19) AS INTEGER) AS bin
              FROM ss WHERE hit ORDER BY proc_ts DESC, transaction_id LIMIT 500)
        GROUP BY bin""", LIVE)
    bad = "label = 'fraud'"
    good = "label <> 'fraud'"
    tp, fp = _n(f"{bad} AND hit"), _n(f"{good} AND hit")
    fn, tn = _n(f"{bad} AND NOT hit"), _n(f"{good} AND NOT hit")
    out["confusion_metrics"] = _sql(f"""SELECT {tp} AS tp, {fp} AS fp, {fn} AS fn, {tn} AS tn,
        {_share(tp, f'{tp} + {fn}')} AS detection_rate,
        {_share(fp, f'{fp} + {tn}')} AS false_positive_rate,
        {_share(tp, f'{tp} + {fp}')} AS precision FROM ss""", LIVE)
    out["label_mix"] = _sql(f"""SELECT label, {N} AS n,
        round(count(*) * 100::DOUBLE / sum(count(*)) OVER (), 8) AS percent
        FROM txn GROUP BY label""")
    out["period_growth"] = _sql(f"""SELECT {ts('day')} AS day, total, fraud,
        lag(total) OVER w AS prev_total, lag(fraud) OVER w AS prev_fraud,
        round((total - lag(total) OVER w)::DOUBLE
              / greatest(1, lag(total) OVER w) * 100, 8) AS growth
        FROM (SELECT date_trunc('day', event_ts) AS day, {N} AS total, {_n('hit')} AS fraud
              FROM ss GROUP BY 1) WINDOW w AS (ORDER BY day)""", LIVE)
    out["txn_over_time"] = _sql(f"""SELECT {ts("date_trunc('hour', event_ts)")} AS window_start,
        {N} AS total, round(sum(amount), 4) AS total_amount FROM ded GROUP BY 1""")
    out["window_tag"] = _sql(f"""SELECT transaction_id,
        {ts("date_trunc('minute', event_ts)")} AS window_start,
        {ts("date_trunc('minute', event_ts) + INTERVAL 1 MINUTE")} AS window_end FROM ded""")
    out["loss_check"] = _sql("""SELECT transaction_id, label FROM chk c WHERE NOT EXISTS (
        SELECT 1 FROM chk s WHERE s.reason IS NULL
          AND s.transaction_id = c.transaction_id)""", FAULTS)

    out["merged_alerts"] = _sql(_merged_select("", 100), DAY, LIVE, MERGED)
    out["merged_totals"] = _sql(f"""SELECT source, {N} AS total, {_n('hit')} AS fraud
        FROM mrg GROUP BY source""", DAY, LIVE, MERGED)
    out["user_fraud_history"] = _sql(
        _merged_select(f"AND user_id = {A_USER}", 50), DAY, LIVE, MERGED)
    out["recent_alerts"] = _sql(
        alert + " ORDER BY proc_ts DESC, transaction_id LIMIT 50", LIVE)
    out["dashboard_timeline"] = _sql(f"""SELECT
        {ts("date_trunc('hour', event_ts) + INTERVAL 1 HOUR")} AS timestamp, country,
        {N} AS transaction_count, round(sum(amount), 4) AS total_amount,
        {_n('hit')} AS fraud_count, round(avg(score), 12) AS avg_fraud_score FROM ss
        GROUP BY 1, 2 ORDER BY timestamp DESC, transaction_count DESC, country ASC NULLS LAST
        LIMIT 100""", LIVE)
    gone = f"proc_ts < {AS_OF} - INTERVAL 2 HOUR"
    out["realtime_retention"] = _sql(
        f"SELECT {_n(gone)} AS deleted, {_n(f'NOT ({gone})')} AS kept FROM ss", LIVE)
    out["layer_stats"] = _sql(" UNION ALL ".join([
        _view_size("batch_views", "sb", "hit"), _view_size("realtime_views", "ss"),
        _view_size("fraud_alerts", "ss", "hit"), _view_size("user_profiles", "prof")]),
        DAY, LIVE, PROFILE)

    late = """SELECT CAST(floor(epoch(proc_ts)) AS BIGINT)
        - CAST(floor(epoch(event_ts)) AS BIGINT) AS d FROM txn"""
    out["lateness_split"] = _sql(f"""SELECT CASE WHEN d <= 30 THEN 'on_time'
        WHEN d <= 300 THEN 'late' ELSE 'too_late' END AS lateness, {N} AS n,
        max(d) AS max_delay FROM ({late}) GROUP BY 1""")
    out["quality_report"] = _sql(f"""SELECT coalesce(reason, 'valid') AS outcome, {N} AS messages
        FROM chk GROUP BY 1""", FAULTS)
    out["batch_rejected"] = _sql(f"""SELECT reason, {N} AS messages FROM chk
        WHERE reason IS NOT NULL GROUP BY 1""", FAULTS)
    delay = """(CAST(floor(epoch(proc_ts)) AS BIGINT)
        - CAST(floor(epoch(event_ts)) AS BIGINT))"""
    out["late_events"] = _sql(f"""SELECT transaction_id, {delay} AS delay_seconds,
        CASE WHEN {delay} <= 300 THEN 'late' ELSE 'too_late' END AS lateness
        FROM txn WHERE {delay} > 30""")
    out["dead_letter"] = _sql(
        "SELECT transaction_id, reason FROM chk WHERE reason IS NOT NULL", FAULTS)
    out["rejection_rate"] = _sql(f"""SELECT {N} AS total, {_n('reason IS NOT NULL')} AS rejected,
        {_share(_n('reason IS NOT NULL'), N)} AS rejection_rate FROM chk""", FAULTS)
    out["imputed"] = _sql(f"""SELECT coalesce(country, 'UNKNOWN') AS country,
        coalesce(merchant_category, 'unknown') AS merchant_category, {N} AS n
        FROM ded GROUP BY 1, 2""")

    out["dedup_stream"] = _sql(f"""SELECT DISTINCT transaction_id, user_id, amount,
        {ts('event_ts', True)} AS event_at FROM txn WHERE amount > 0""")
    out["dedup_stream_by_id"] = _sql(
        "SELECT DISTINCT transaction_id, user_id, amount FROM txn WHERE amount > 0")
    out["stream_enriched"] = _sql(f"""SELECT transaction_id,
        {ts('proc_ts', True)} AS arrived_at, country_risk, merchant_risk FROM raws""",
        RAW_STREAM)
    out["stream_window_stats"] = _sql(_closed_windows(
        "rs", "1 minute", "country", f", {_n('hit')} AS fraud_count", "(0)"), RAW_STREAM)
    out["stream_sliding_stats"] = _sql(_closed_windows(
        "rs", "30 seconds", "", "", "(0), (1)"), RAW_STREAM)
    live = "(SELECT * FROM ss WHERE amount > 0)"
    out["stream_alerts"] = _sql(f"""SELECT transaction_id, user_id, amount, country,
        round(score, 6) AS fraud_score FROM {live} WHERE hit""", LIVE)
    out["stream_scored"] = _sql(f"""SELECT transaction_id, user_id, amount,
        round(score, 6) AS fraud_score, hit AS is_fraud_predicted,
        {ts("date_trunc('minute', event_ts)")} AS window_start,
        {ts("date_trunc('minute', event_ts) + INTERVAL 1 MINUTE")} AS window_end
        FROM {live}""", LIVE)
    out["replayed_view"] = out["stream_scored"]
    out["microbatch_country_stats"] = _sql(f"""SELECT country, {N} AS transaction_count,
        round(sum(amount), 4) AS total_amount, {_n('hit')} AS fraud_count,
        round(avg(score), 12) AS avg_fraud_score, {ts(AS_OF)} AS timestamp,
        CAST(0 AS BIGINT) AS batch_no FROM {live} GROUP BY country""", LIVE)
    out["fanout_counts"] = _sql(f"""
        SELECT 'realtime_views' AS view, {N} AS rows, {ts(AS_OF)} AS last_batch FROM {live}
        UNION ALL SELECT 'fraud_alerts', {_n('hit')}, {ts(AS_OF)} FROM {live}
        UNION ALL SELECT 'dashboard_stats', CAST(count(*) AS BIGINT), {ts(AS_OF)}
        FROM (SELECT DISTINCT country FROM {live})""", LIVE)
    out["current_user_risk"] = _sql(f"""SELECT user_id, round(score, 6) AS risk_score,
        {ts('event_ts', True)} AS scored_at
        FROM (SELECT DISTINCT user_id, score, event_ts, transaction_id FROM rs)
        QUALIFY row_number() OVER (PARTITION BY user_id
          ORDER BY event_ts DESC, transaction_id DESC) = 1""", RAW_STREAM)

    out["active_user_risk"] = _sql(f"""SELECT user_id, round(score, 6) AS risk_score,
        {ts('event_ts', True)} AS scored_at
        FROM (SELECT DISTINCT user_id, score, event_ts, transaction_id FROM rs)
        QUALIFY row_number() OVER (PARTITION BY user_id
          ORDER BY event_ts DESC, transaction_id DESC) = 1
          AND event_ts + INTERVAL 1 DAY
            > (SELECT max(event_ts) FROM rs) - INTERVAL 30 SECOND""", RAW_STREAM)
    out["user_risk_state"] = out["active_user_risk"]
    out["dedup_state"] = _sql(f"""SELECT DISTINCT transaction_id,
        {ts('event_ts', True)} AS event_at FROM rs
        WHERE event_ts > (SELECT max(event_ts) FROM rs) - INTERVAL 1 DAY""", RAW_STREAM)
    closed = f"""(SELECT *, {MINUTE_CLOSED} AS closed FROM rs)"""
    spans = [(f"'{name}'", ts(f"date_trunc('{name}', event_ts)"), "GROUP BY 2")
             for name in ("hour", "day")] + [("'all'", "NULL", "")]
    out["active_users_sketch"] = _sql(" UNION ALL ".join(
        f"""SELECT {name} AS span, {start} AS window_start,
        CAST(count(DISTINCT user_id) AS BIGINT) AS active_users
        FROM {closed} WHERE closed {group}""" for name, start, group in spans), RAW_STREAM)
    ranked = ", ".join(f"round(quantile_disc(delay, {q}), 6) AS {n}"
                       for n, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)))
    out["delay_sketch_quantiles"] = _sql(f"""SELECT {ts("date_trunc('hour', event_ts)")}
        AS window_start, {N} AS count, {ranked} FROM (SELECT *,
          date_diff('second', event_ts, proc_ts)::DOUBLE AS delay FROM {closed})
        WHERE closed GROUP BY 1""", RAW_STREAM)

    out["training_set"] = _sql("""SELECT transaction_id,
        CASE WHEN label = 'fraud' THEN 1::DOUBLE ELSE 0::DOUBLE END AS label,
        CAST('0x' || substr(md5(transaction_id), 1, 8) AS BIGINT) % 100 < 80 AS in_train
        FROM ded WHERE label IN ('normal', 'fraud')""")

    outcome = """(SELECT 'stream' AS layer,
        CASE WHEN reason IS NULL THEN 'success' ELSE 'error' END AS status, seen_ts FROM chk)"""
    out["metric_transactions"] = _sql(
        f"SELECT layer, status, {N} AS total FROM {outcome} GROUP BY 1, 2", FAULTS)
    out["metric_fraud"] = _sql(
        f"SELECT layer, country, {N} AS total FROM lay WHERE hit GROUP BY 1, 2",
        DAY, LIVE, LAYERS)
    out["latency_histogram"] = _histogram(
        "(SELECT 'stream' AS layer, value FROM events)", "value / 100::DOUBLE",
        PROCESSING_LATENCY_BOUNDS, "layer")
    out["e2e_latency_histogram"] = _sql(_histogram(
        f"(SELECT 'stream' AS layer, d FROM ({late}))", "d::DOUBLE", E2E_LATENCY_BOUNDS,
        "layer"))
    out["metric_score_histogram"] = _sql(
        _histogram("ss", "round(score, 6)", SCORE_BOUNDS), LIVE)
    out["active_users"] = _sql(f"""SELECT {ts("date_trunc('hour', event_ts)")} AS window_start,
        CAST(count(DISTINCT user_id) AS BIGINT) AS active_users FROM ded GROUP BY 1""")
    five = ts("time_bucket(INTERVAL 5 MINUTE, {})")
    out["rate_5m"] = _sql(f"""SELECT {five.format('seen_ts')} AS window_start, layer, status,
        {N} AS n, round(count(*)::DOUBLE / 300, 9) AS rate
        FROM {outcome} WHERE seen_ts IS NOT NULL GROUP BY 1, 2, 3""", FAULTS)
    out["fraud_rate_5m"] = _sql(f"""SELECT {five.format('event_ts')} AS window_start, country,
        {N} AS n, round(count(*)::DOUBLE / 300, 9) AS rate FROM ss WHERE hit GROUP BY 1, 2""",
        LIVE)
    counts = ", ".join(f"{_n(f'value / 100::DOUBLE <= {b}::DOUBLE')} AS b{i}"
                       for i, b in enumerate(PROCESSING_LATENCY_BOUNDS))
    out["latency_quantiles"] = f"""SELECT {five.format('bucket')} AS window_start, n AS count,
        {', '.join(f'round({_quantile(q)}, 9) AS {n}'
                   for n, q in (('p50', 0.5), ('p95', 0.95), ('p99', 0.99)))}
        FROM (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS bucket, {N} AS n, {counts}
              FROM events GROUP BY 1)"""

    out["batch_scored"] = _sql("""SELECT transaction_id, user_id, amount, country_risk,
        merchant_risk, velocity_count, round(velocity_amount, 4) AS velocity_amount,
        gap AS time_since_last, round(z, 4) AS amount_zscore, round(score, 6) AS fraud_score,
        hit AS is_fraud_predicted FROM sb""", SHORT)
    out["batch_scored_as_of"] = _sql(f"""SELECT transaction_id, country_risk, merchant_risk,
        round({BATCH_SCORE}, 6) AS fraud_score, {BATCH_SCORE} >= 0.7::DOUBLE
          AS is_fraud_predicted FROM {_as_of('feat')}""", SHORT)
    out["stream_scored_as_of"] = _sql(f"""SELECT transaction_id, country_risk, merchant_risk,
        round({STREAM_SCORE}, 6) AS fraud_score, {STREAM_SCORE} >= 0.7::DOUBLE
          AS is_fraud_predicted,
        round(CASE WHEN dev > 0 THEN (amount - mean) / dev ELSE 0::DOUBLE END, 4)
          AS amount_zscore,
        country IS NOT NULL AND known IS NOT NULL
          AND NOT coalesce(list_contains(known, country), false) AS is_new_country
        FROM {_as_of('enr')} e LEFT JOIN (
          SELECT user_id AS of, avg(amount) AS mean, stddev_samp(amount) AS dev,
            coalesce(list(DISTINCT country) FILTER (country IS NOT NULL), []) AS known
          FROM ded WHERE event_ts < {LAST_BATCH} GROUP BY user_id) k ON k.of = e.user_id
        WHERE amount > 0""")
    out["incremental_scored"] = out["batch_scored"]
    out["incremental_country_stats"] = _sql(f"""SELECT country, {N} AS total_transactions,
        round(sum(amount), 4) AS total_amount, {_n('hit')} AS fraud_count,
        round(avg(score), 10) AS avg_fraud_score,
        {_share(_n('hit'), N)} AS fraud_rate FROM sb GROUP BY country""", SHORT)
    out["incremental_parts"] = _sql(f"""SELECT strftime(event_ts, 'day=%Y-%m-%d') AS part,
        {N} AS total_transactions, CAST(CASE WHEN strftime(event_ts, '%Y-%m-%d') IN
          ('2024-01-10', '2024-01-11') THEN 2 ELSE 1 END AS BIGINT) AS version
        FROM ded GROUP BY ALL""")
    return out
