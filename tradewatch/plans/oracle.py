"""The registered queries as plain SQL over the same tables, for an independent engine.

Shared fragments are common table expressions; numbers are rounded half up to six decimals the
same way on both sides, and price sums are taken over whole cents.
"""

from __future__ import annotations


def r(x: str, digits: int = 6) -> str:
    return f"floor(({x}) * 1e{digits} + 0.5e0) / 1e{digits}"


def times(*names: str) -> str:
    return ", ".join(names)


TRADES = """trades AS (
  SELECT event_id AS trade_id,
         CASE event_type WHEN 'click' THEN 'BTC/USDT' WHEN 'view' THEN 'ETH/USDT'
              WHEN 'purchase' THEN 'BNB/USDT' WHEN 'signup' THEN 'SOL/USDT'
              WHEN 'error' THEN 'XRP/USDT' END AS symbol,
         ts AS event_time, value AS price,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS quantity,
         user_id % 2 = 1 AS is_buyer_maker, FALSE AS injected
  FROM events)"""

WINDOWED = f"""{TRADES},
slots AS (
  SELECT *, unnest([b, b - INTERVAL 8 HOUR, b - INTERVAL 16 HOUR]) AS window_start
  FROM (SELECT *, time_bucket(INTERVAL 8 HOUR, event_time, TIMESTAMP '1970-01-01 00:00:00') AS b FROM trades)),
grouped AS (
  SELECT symbol, window_start, window_start + INTERVAL 1 DAY AS window_end,
         first(price ORDER BY event_time, trade_id) AS first_price,
         last(price ORDER BY event_time, trade_id) AS last_price,
         sum(CAST(round(price * 100) AS BIGINT))::DOUBLE / (count(price) * 1e2) AS avg_price,
         stddev_samp(price) AS std_price, sum(quantity) AS window_volume, avg(quantity) AS avg_quantity,
         max(quantity) AS max_quantity, count(*) AS trade_count, 0::BIGINT AS injected_count,
         min(event_time) AS min_event_time, max(event_time) AS max_event_time
  FROM slots GROUP BY symbol, window_start),
feats AS (
  SELECT *, CASE WHEN first_price = 0 THEN 0e0
                 ELSE (last_price - first_price) / (first_price + 1e-9) * 1e2 END AS price_change_pct,
         max_quantity / (avg_quantity + 1e-9) AS volume_spike,
         CASE WHEN std_price > 0 THEN (last_price - avg_price) / std_price ELSE 0e0 END AS z_score,
         floor(epoch_us(max_event_time) / 1000000)::BIGINT - floor(epoch_us(min_event_time) / 1000000)::BIGINT AS time_range_sec,
         strftime(max_event_time, '%Y-%m-%d-%H') AS hour
  FROM grouped),
limits(symbol, z, v, p) AS (
  VALUES ('BTC/USDT', 2.2e0, NULL::DOUBLE, NULL::DOUBLE), ('ETH/USDT', NULL, 1.97e0, NULL),
         ('SOL/USDT', 2.5e0, NULL, 2e3)),
limited AS (
  SELECT f.*, f.time_range_sec::DOUBLE / f.trade_count AS time_gap_sec,
         coalesce(l.z, 2e0) AS z_threshold, coalesce(l.v, 1.95e0) AS volume_threshold,
         coalesce(l.p, 1.5e3) AS price_change_threshold
  FROM feats f LEFT JOIN limits l USING (symbol)),
flagged AS (
  SELECT *, abs(z_score) > z_threshold AS is_z_anomaly, volume_spike > volume_threshold AS is_volume_anomaly,
         abs(price_change_pct) > price_change_threshold AS is_price_change_anomaly,
         abs(z_score) > 2.1e0 OR abs(price_change_pct) > 1.8e3 AS is_if_anomaly,
         greatest(abs(z_score) / 2.1e0, abs(price_change_pct) / 1.8e3) AS if_anomaly_score
  FROM limited),
fused AS (
  SELECT *, is_z_anomaly AND is_if_anomaly AS is_filtered_anomaly,
         CASE WHEN is_z_anomaly AND is_if_anomaly
              THEN abs(z_score) / z_threshold * if_anomaly_score ELSE 0e0 END AS filtered_confidence,
         is_z_anomaly OR is_if_anomaly OR is_volume_anomaly OR is_price_change_anomaly AS is_anomaly,
         CASE WHEN is_z_anomaly AND is_if_anomaly THEN 'filtered' WHEN is_z_anomaly THEN 'z'
              WHEN is_if_anomaly THEN 'if' WHEN is_price_change_anomaly THEN 'pct'
              WHEN is_volume_anomaly THEN 'volume' ELSE 'none' END AS anomaly_type
  FROM flagged),
scored AS (
  SELECT *, CASE anomaly_type WHEN 'filtered' THEN filtered_confidence WHEN 'z' THEN abs(z_score)
                 WHEN 'if' THEN if_anomaly_score WHEN 'pct' THEN abs(price_change_pct)
                 WHEN 'volume' THEN volume_spike ELSE 0e0 END AS anomaly_score,
         CASE WHEN anomaly_type = 'filtered' THEN 'high' WHEN anomaly_type IN ('z', 'if') THEN 'medium'
              WHEN is_anomaly THEN 'low' ELSE 'none' END AS detection_quality
  FROM fused)"""

INJECT = """injected_trades AS (
  SELECT t.* EXCLUDE (price, injected),
         ((trade_id % 1000003) * 7919) % 10007 < {cut} AS injected,
         CASE WHEN ((trade_id % 1000003) * 7919) % 10007 < {cut} THEN
           price * (CASE ((((trade_id % 1000003) * 7919) + 209458) % 10007) % 4
                    WHEN 0 THEN {f0} WHEN 1 THEN {f1} WHEN 2 THEN {f2} ELSE {f3} END) ELSE price END AS price,
         CASE WHEN ((trade_id % 1000003) * 7919) % 10007 < {cut} THEN
           (CASE ((((trade_id % 1000003) * 7919) + 209458) % 10007) % 4
            WHEN 0 THEN 'price_spike_5pct' WHEN 1 THEN 'price_drop_5pct'
            WHEN 2 THEN 'price_spike_8pct' ELSE 'price_drop_8pct' END) END AS injection_kind
  FROM trades t)"""

SPIKES = INJECT.format(cut=500, f0="1.05e0", f1="0.95e0", f2="1.08e0", f3="0.92e0")
BIG_SPIKES = INJECT.format(cut=500, f0="6e0", f1="0.2e0", f2="9e0", f3="0.1e0")


def rolling(source: str = "trades", unit: str = "1e2", window: int = 1000) -> str:
    """Rolling features of a trade table, by plain row frames."""
    def last(k: int) -> str:
        return f"OVER (PARTITION BY symbol ORDER BY event_time, trade_id ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"

    o = "OVER (PARTITION BY symbol ORDER BY event_time, trade_id)"
    cents = f"CAST(round(price * {unit}) AS BIGINT)"
    return f"""measured AS (
  SELECT *, least(row_number() {o}, {window}) AS n, row_number() {o} AS rn,
         lag(price) {o} AS prev, epoch_us(event_time) - epoch_us(lag(event_time) {o}) AS gap_us,
         lag(price, 19) {o} AS old, epoch_us(event_time) - epoch_us(lag(event_time, 19) {o}) AS old_us,
         sum({cents}) {last(window)} AS sum_p, stddev_samp(price) {last(window)} AS std_p,
         sum(quantity) {last(window)} AS q1000, sum({cents} * quantity) {last(100)} AS pq100,
         sum(quantity) {last(100)} AS q100, sum(quantity) {last(50)} AS q50, sum(quantity) {last(10)} AS q10,
         sum(CASE WHEN NOT is_buyer_maker THEN quantity ELSE 0e0 END) {last(10)} AS b10
  FROM {source}),
ready AS (
  SELECT *, n::BIGINT AS history_length, coalesce(price - prev, 0e0) AS price_change,
         CASE WHEN prev > 0 THEN (price - prev) / prev * 100 ELSE 0e0 END AS price_change_pct,
         coalesce(greatest(gap_us / 1e6, 0e0), 0e0) AS time_gap_sec,
         CASE WHEN n >= 50 THEN sum_p::DOUBLE / (n * {unit}) ELSE price END AS rolling_mean,
         CASE WHEN n >= 50 THEN std_p ELSE 0e0 END AS rolling_std,
         CASE WHEN n >= 50 AND q1000 > 0 THEN quantity / (q1000 / n) ELSE 1e0 END AS volume_ratio,
         CASE WHEN n >= 50 AND q50 > 0 THEN quantity / (q50 / 50) ELSE 1e0 END AS volume_spike,
         CASE WHEN n >= 50 AND q10 > 0 THEN b10 / q10 ELSE 0.5e0 END AS buy_pressure,
         CASE WHEN n >= 50 AND old_us > 0 THEN (price - old) / (old_us / 1e6) ELSE 0e0 END AS price_velocity,
         n >= 100 AND q100 > 0 AS traded,
         extract(hour FROM event_time) AS hour, (extract(isodow FROM event_time) - 1) AS day_of_week,
         CASE WHEN extract(isodow FROM event_time) >= 6 THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN extract(hour FROM event_time) >= 23 OR extract(hour FROM event_time) < 8 THEN 'asian'
              WHEN extract(hour FROM event_time) < 16 THEN 'european' ELSE 'us' END AS trading_session
  FROM measured),
featured AS (
  SELECT *, CASE WHEN rolling_std > 0 THEN (price - rolling_mean) / rolling_std ELSE 0e0 END AS z_score,
         CASE WHEN traded THEN pq100 / (q100 * {unit}) ELSE rolling_mean END AS vwap
  FROM ready),
rolled AS (
  SELECT *, CASE WHEN traded AND vwap <> 0 THEN (price - vwap) / vwap * 100 ELSE 0e0 END AS vwap_deviation
  FROM featured),
modelled AS (
  SELECT *, abs(z_score) > 3e0 OR abs(price_change_pct) > 2e4 AS is_if_anomaly, abs(z_score) > 3.5e0 AS is_z
  FROM rolled),
labelled AS (
  SELECT *, 'z_score' AS anomaly_type FROM modelled WHERE history_length >= 50 AND is_z
  UNION ALL
  SELECT *, CASE WHEN is_z THEN 'filtered_isoforest' ELSE 'isoforest' END FROM modelled
  WHERE history_length >= 50 AND is_if_anomaly)"""


ROLLED = f"{TRADES}, {rolling()}"

_PLAIN3 = "regexp_replace(CAST(CAST({x} AS DECIMAL(38,{d})) AS VARCHAR), '(\\.[0-9]+?)0+$', '\\1')"


def number_text(x: str, d: int = 6) -> str:
    return _PLAIN3.format(x=r(x, d), d=d)


def iso(ts: str) -> str:
    return f"regexp_replace(strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f'), '\\.000000$', '')"


ANOMALY_COLUMNS = f"""symbol, max_event_time AS timestamp, {r('last_price')} AS price, {r('z_score')} AS z_score,
  {r('price_change_pct')} AS price_change_pct, {r('volume_spike')} AS volume_spike"""

PAYLOADS = f"""{WINDOWED},
payloads AS (
  SELECT symbol, {iso('max_event_time')} AS timestamp, last_price AS price, z_score, price_change_pct,
         volume_spike, anomaly_type, anomaly_score, 'dispatcher' AS source
  FROM scored WHERE is_anomaly AND max_event_time >= greatest(
    TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 40320 MINUTE, TIMESTAMP '2024-01-05 00:00:00')),
keyed AS (
  SELECT *, sha1(concat_ws('|', symbol, timestamp, anomaly_type, {number_text('anomaly_score', 3)})) AS alert_key
  FROM payloads)"""

FOLD = """numbered AS (
  SELECT *, row_number() OVER (PARTITION BY symbol, anomaly_type ORDER BY event_time, trade_id) AS k
  FROM ({source})),
fold AS (
  SELECT *, event_time AS passed_at, TRUE AS passes FROM numbered WHERE k = 1
  UNION ALL
  SELECT n.*, CASE WHEN n.event_time >= f.passed_at + INTERVAL 21600 SECOND THEN n.event_time ELSE f.passed_at END,
         n.event_time >= f.passed_at + INTERVAL 21600 SECOND
  FROM fold f JOIN numbered n ON n.symbol = f.symbol AND n.anomaly_type = f.anomaly_type AND n.k = f.k + 1)"""

LABELS = "SELECT trade_id, symbol, event_time, anomaly_type, price, z_score, price_change_pct, volume_spike FROM labelled"
COOLDOWN = f"{ROLLED}, {FOLD.format(source=LABELS)}"

DECIDED = """decided AS (
  SELECT symbol, greatest((trade_id * 37) % 1000 - 20, 0)::DOUBLE AS e2e_ms FROM trades)"""

LATENCY = ", ".join(
    f"{r(f'quantile_cont(e2e_ms, {p})')} AS e2e_{n}_ms"
    for n, p in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99), ("max", 1.0))
)

LAG = """lags AS (
  SELECT sample, min(lag) AS low, avg(lag) AS mean, max(lag) AS high FROM (
    SELECT date_trunc('day', event_time) AS sample, trade_id % 3 AS part,
           greatest(max(trade_id) - CASE WHEN trade_id % 3 = 2 THEN 0 ELSE min(trade_id) END, 0) AS lag
    FROM trades GROUP BY 1, 2) GROUP BY sample)"""

WRITES = "trade_id % 50 NOT IN (0, 3) AND trade_id % 5 NOT IN (1, 2)"

INTERVALS = """intervals AS (
  SELECT time_bucket(INTERVAL 6 HOUR, event_time, TIMESTAMP '1970-01-01 00:00:00') AS interval_start,
         coalesce(avg(CASE WHEN {writes} THEN (trade_id % 16)::DOUBLE END), 0e0) AS io_write_ms_avg,
         coalesce(sum(CASE WHEN {writes} THEN trade_id % 100 + 200 END), 0)::BIGINT AS bytes_written,
         count(*) FILTER (trade_id % 50 = 0) AS refits,
         coalesce(sum(CASE WHEN trade_id % 50 = 0 THEN (trade_id % 16)::DOUBLE END), 0e0) AS refit_time_ms
  FROM trades GROUP BY 1)""".format(writes=WRITES)

SPELLED = """spelled AS (
  SELECT trade_id, CASE trade_id % 5 WHEN 0 THEN replace(symbol, '/', '') WHEN 1 THEN lower(replace(symbol, '/', '-'))
                   WHEN 2 THEN '  ' || symbol || ' ' WHEN 3 THEN substr(symbol, 1, 3) END AS spelling
  FROM trades)"""


def candles(interval: str, flag: str) -> str:
    return f"""SELECT symbol, time_bucket(INTERVAL {interval}, event_time, TIMESTAMP '1970-01-01 00:00:00') AS bucket,
  {r('first(price ORDER BY event_time, trade_id)')} AS open, {r('max(price)')} AS high, {r('min(price)')} AS low,
  {r('last(price ORDER BY event_time, trade_id)')} AS close, {r('sum(quantity)')} AS volume{flag}
  FROM trades GROUP BY 1, 2"""


IS_UP = ", last(price ORDER BY event_time, trade_id) >= first(price ORDER BY event_time, trade_id) AS is_up"


def confusion(source: str) -> str:
    return f"""counted AS (
  SELECT count(*) FILTER (truth AND predicted) AS tp, count(*) FILTER (NOT truth AND predicted) AS fp,
         count(*) FILTER (truth AND NOT predicted) AS fn, count(*) FILTER (NOT truth AND NOT predicted) AS tn
  FROM {source})"""


def share(part: str, whole: str) -> str:
    return r(f"coalesce(({part})::DOUBLE / nullif({whole}, 0), 0e0)")


AGAINST_PROXY = f"""{ROLLED},
judged AS (SELECT abs(z_score) > 3.5e0 AS truth, is_if_anomaly AS predicted FROM modelled),
{confusion('judged')}"""

CONFUSION_COLUMNS = (
    f"tp, fp, fn, tn, {share('tp', 'tp + fp')} AS precision, {share('tp', 'tp + fn')} AS recall, "
    f"{share('2 * tp', '2 * tp + fp + fn')} AS f1"
)

CLOSED = "window_end <= (SELECT max(event_time) FROM trades) - INTERVAL 30 SECOND"

ORACLE: dict[str, str] = {
    "parse_trades_json": f"""WITH {TRADES} SELECT symbol, make_timestamp(epoch_us(event_time) // 1000 * 1000) AS timestamp,
        {r('price')} AS price, {r('quantity')} AS quantity, trade_id,
        CASE WHEN trade_id % 10 = 9 THEN FALSE ELSE is_buyer_maker END AS is_buyer_maker, FALSE AS injected,
        make_timestamp(epoch_us(event_time) // 1000 * 1000) AS event_time
        FROM trades WHERE trade_id % 10 NOT IN (3, 5, 7)""",
    "malformed_counts": f"""WITH {TRADES} SELECT count(*) FILTER (trade_id % 10 NOT IN (3, 5, 7)) AS accepted,
        count(*) FILTER (trade_id % 10 IN (3, 5, 7)) AS rejected, count(*) AS total FROM trades""",
    "parse_exchange_envelope": f"""WITH {TRADES} SELECT symbol, make_timestamp(epoch_us(event_time) // 1000 * 1000) AS timestamp,
        {r('price')} AS price, {r('quantity')} AS quantity, trade_id, is_buyer_maker, FALSE AS injected,
        make_timestamp(epoch_us(event_time) // 1000 * 1000) AS event_time FROM trades WHERE trade_id % 11 <> 4""",
    "scan_parquet": "SELECT event_type, count(*) AS rows, max(event_id) AS last_id FROM events GROUP BY event_type",
    "scan_since": f"SELECT event_id, ts, {r('value')} AS value FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00'",
    "supported_symbols_only": f"""WITH {TRADES} SELECT symbol, count(*) AS trades FROM trades
        WHERE symbol IN ('BTC/USDT', 'ETH/USDT', 'SOL/USDT', 'ADA/USDT') GROUP BY symbol""",
    "trades_to_kafka_records": f"""WITH {TRADES} SELECT symbol, count(*) AS messages, {r('sum(quantity)')} AS quantity,
        max(trade_id) AS last_id FROM trades GROUP BY symbol""",
    "epoch_autodetect": f"""WITH {TRADES} SELECT trade_id, u.feed AS feed, u.unit AS epoch_unit,
        date_trunc('second', event_time) AS decoded FROM trades,
        (VALUES ('a', 's'), ('b', 'ms'), ('c', 'us'), ('d', 'ns')) u(feed, unit)""",
    "normalize_symbol": f"""WITH {TRADES}, {SPELLED}, cleaned AS (
        SELECT *, replace(trim(upper(spelling)), '-', '/') AS s FROM spelled)
        SELECT trade_id, spelling, coalesce(CASE WHEN contains(s, '/') OR length(s) <= 3 THEN s
        ELSE regexp_replace(s, '^(.+)(USDT|USD|USDC|BTC|ETH|BNB)$', '\\1/\\2') END, '') AS normalized FROM cleaned""",
    "stream_symbol": f"""WITH {TRADES}, {SPELLED} SELECT trade_id,
        lower(regexp_replace(trim(spelling), '[-/]', '', 'g')) AS stream FROM spelled""",
    "coerce_numeric": f"""WITH {TRADES}, texts AS (SELECT trade_id, CASE trade_id % 4
          WHEN 1 THEN CAST(quantity::BIGINT AS VARCHAR) || 'x' WHEN 2 THEN ''
          ELSE CAST(quantity::BIGINT AS VARCHAR) END AS t FROM trades)
        SELECT trade_id, {r('TRY_CAST(t AS DOUBLE)')} AS parsed, {r('coalesce(TRY_CAST(t AS DOUBLE), 0e0)')} AS filled
        FROM texts""",
    "calendar_features": f"""WITH {ROLLED} SELECT trade_id, hour, day_of_week, is_weekend::BIGINT AS is_weekend,
        trading_session FROM ready""",
    "window_features": f"""WITH {WINDOWED} SELECT symbol, {r('first_price')} AS first_price, {r('last_price')} AS last_price,
        {r('avg_price')} AS avg_price, {r('std_price')} AS std_price, {r('window_volume')} AS window_volume,
        {r('avg_quantity')} AS avg_quantity, {r('max_quantity')} AS max_quantity, trade_count, injected_count,
        min_event_time, max_event_time, {r('price_change_pct')} AS price_change_pct, {r('volume_spike')} AS volume_spike,
        {r('z_score')} AS z_score, time_range_sec, {r('time_gap_sec')} AS mean_interarrival_sec,
        {r('time_gap_sec')} AS time_gap_sec, max_event_time AS latest_event_time, window_start, window_end, hour
        FROM limited""",
    "trades_output": f"""WITH {WINDOWED} SELECT symbol, max_event_time AS timestamp, {r('last_price')} AS price,
        {r('window_volume')} AS window_volume, {r('z_score')} AS z_score, {r('price_change_pct')} AS price_change_pct,
        {r('volume_spike')} AS volume_spike, hour, window_start, window_end, trade_count FROM feats""",
    "threshold_join": f"""WITH {WINDOWED} SELECT symbol, window_start, {r('z_threshold')} AS z_threshold,
        {r('volume_threshold')} AS volume_threshold, {r('price_change_threshold')} AS price_change_threshold FROM limited""",
    "rule_flags": f"""WITH {WINDOWED} SELECT symbol, window_start, is_z_anomaly, is_volume_anomaly,
        is_price_change_anomaly FROM flagged""",
    "model_flags_stub": f"""WITH {WINDOWED} SELECT symbol, window_start, is_if_anomaly,
        {r('if_anomaly_score')} AS if_anomaly_score FROM flagged""",
    "detections": f"""WITH {WINDOWED} SELECT symbol, window_start, is_filtered_anomaly,
        {r('filtered_confidence')} AS filtered_confidence, is_anomaly, anomaly_type, {r('anomaly_score')} AS anomaly_score,
        detection_quality FROM scored""",
    "anomalies_output": f"""WITH {WINDOWED} SELECT {ANOMALY_COLUMNS}, {r('time_gap_sec')} AS time_gap_sec, anomaly_type,
        {r('anomaly_score')} AS anomaly_score, hour, window_start, window_end, {r('if_anomaly_score')} AS if_anomaly_score
        FROM scored WHERE is_anomaly""",
    "console_projection": f"""WITH {WINDOWED} SELECT symbol, max_event_time AS time_uk, max_event_time AS time_utc,
        {r('last_price')} AS price, {r('round(z_score, 2)')} AS z_score, anomaly_type,
        {r('round(anomaly_score, 2)')} AS score FROM scored WHERE is_anomaly""",
    "anomalies_since_top": f"""WITH {WINDOWED} SELECT {ANOMALY_COLUMNS}, anomaly_type, {r('anomaly_score')} AS anomaly_score
        FROM scored WHERE is_anomaly AND max_event_time >= TIMESTAMP '2024-01-10 00:00:00'
        ORDER BY max_event_time, symbol, anomaly_type LIMIT 200""",
    "trade_deltas": f"""WITH {ROLLED} SELECT trade_id, {r('price_change')} AS price_change,
        {r('price_change_pct')} AS price_change_pct, {r('time_gap_sec')} AS time_gap_sec FROM ready""",
    "rolling_features": f"""WITH {ROLLED} SELECT trade_id, symbol, history_length, {r('rolling_mean')} AS rolling_mean,
        {r('rolling_std')} AS rolling_std, {r('z_score')} AS z_score, {r('volume_ratio')} AS volume_ratio,
        {r('volume_spike')} AS volume_spike FROM rolled""",
    "rolling_features_blocks": f"""WITH {TRADES}, {rolling(window=120)} SELECT trade_id, symbol, history_length,
        {r('rolling_mean')} AS rolling_mean, {r('rolling_std')} AS rolling_std, {r('z_score')} AS z_score, {r('vwap')} AS vwap,
        {r('price_velocity')} AS price_velocity, {r('buy_pressure')} AS buy_pressure, {r('volume_spike')} AS volume_spike,
        {r('price_change_pct')} AS price_change_pct, {r('time_gap_sec')} AS time_gap_sec FROM rolled""",
    "rolling_vwap": f"WITH {ROLLED} SELECT trade_id, {r('vwap')} AS vwap, {r('vwap_deviation')} AS vwap_deviation FROM rolled",
    "rolling_velocity": f"WITH {ROLLED} SELECT trade_id, {r('price_velocity')} AS price_velocity FROM rolled",
    "rolling_buy_pressure": f"WITH {ROLLED} SELECT trade_id, {r('buy_pressure')} AS buy_pressure FROM rolled",
    "rolling_trades_table": f"""WITH {ROLLED} SELECT trade_id AS id, symbol, event_time AS timestamp, {r('price')} AS price,
        {r('quantity')} AS quantity, is_buyer_maker::BIGINT AS is_buyer_maker, {r('z_score')} AS z_score,
        {r('rolling_mean')} AS rolling_mean, {r('rolling_std')} AS rolling_std, {r('price_change_pct')} AS price_change_pct,
        {r('time_gap_sec')} AS time_gap_sec, {r('volume_ratio')} AS volume_ratio, {r('buy_pressure')} AS buy_pressure,
        {r('vwap')} AS vwap, {r('vwap_deviation')} AS vwap_deviation, {r('price_velocity')} AS price_velocity,
        {r('volume_spike')} AS volume_spike, hour, day_of_week, trading_session, is_weekend::BIGINT AS is_weekend,
        0::BIGINT AS injected FROM rolled""",
    "rolling_detections": f"""WITH {ROLLED} SELECT trade_id, symbol, event_time, anomaly_type, {r('z_score')} AS z_score
        FROM labelled""",
    "rolling_anomalies_table": f"""WITH {TRADES}, {SPIKES}, {rolling('injected_trades', '1e4')} SELECT trade_id, symbol,
        event_time AS timestamp, anomaly_type || CASE WHEN injected THEN '_injected' ELSE '' END AS anomaly_type,
        {r('price')} AS price, {r('z_score')} AS z_score, {r('price_change_pct')} AS price_change_pct,
        {r('volume_spike')} AS volume_spike, {r('vwap_deviation')} AS vwap_deviation FROM labelled""",
    "training_tail": f"""WITH {ROLLED} SELECT trade_id AS id, symbol, event_time AS timestamp, {r('z_score')} AS z_score,
        {r('price_change_pct')} AS price_change_pct, {r('time_gap_sec')} AS time_gap_sec FROM rolled
        ORDER BY event_time DESC, trade_id DESC LIMIT 10000""",
    "warm_start_history": f"""WITH {TRADES}, ranked AS (SELECT *, row_number() OVER (PARTITION BY symbol
        ORDER BY event_time DESC, trade_id DESC) AS k FROM trades WHERE event_time <= TIMESTAMP '2024-01-30 12:00:00'
        AND event_time >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 10080 MINUTE)
        SELECT symbol, trade_id, event_time, {r('price')} AS price, {r('quantity')} AS quantity, is_buyer_maker
        FROM ranked WHERE k <= 100""",
    "retrain_points": f"""WITH {TRADES}, n AS (SELECT *, row_number() OVER (PARTITION BY symbol
        ORDER BY event_time, trade_id) AS trade_number FROM trades) SELECT symbol, trade_id, event_time, trade_number,
        CASE WHEN trade_number = 149 THEN 'first' ELSE 'periodic' END AS reason
        FROM n WHERE trade_number = 149 OR (trade_number > 149 AND trade_number % 500 = 0)""",
    "cooldown_thinning": f"WITH RECURSIVE {COOLDOWN} SELECT trade_id, symbol, event_time, anomaly_type FROM fold WHERE passes",
    "cooldown_blocks": f"""WITH RECURSIVE {TRADES}, found AS (
        SELECT trade_id, symbol, event_time, row_number() OVER (PARTITION BY symbol ORDER BY event_time, trade_id) AS k FROM trades),
        fold AS (SELECT *, TRUE AS passes, event_time AS last FROM found WHERE k = 1
          UNION ALL SELECT f.*, f.event_time - p.last >= INTERVAL 21600 SECOND,
            CASE WHEN f.event_time - p.last >= INTERVAL 21600 SECOND THEN f.event_time ELSE p.last END
          FROM fold p JOIN found f ON f.symbol = p.symbol AND f.k = p.k + 1)
        SELECT trade_id, symbol, event_time FROM fold WHERE passes""",
    "alert_payloads": f"""WITH {PAYLOADS} SELECT symbol, timestamp, {r('price')} AS price, {r('z_score')} AS z_score,
        {r('price_change_pct')} AS price_change_pct, {r('volume_spike')} AS volume_spike, anomaly_type,
        {r('anomaly_score')} AS anomaly_score, source FROM payloads""",
    "alert_keys": f"WITH {PAYLOADS} SELECT symbol, timestamp, anomaly_type, alert_key FROM keyed",
    "alert_dedup": f"WITH {PAYLOADS} SELECT DISTINCT alert_key, symbol, timestamp, anomaly_type FROM keyed",
    "alert_messages": f"""WITH {PAYLOADS} SELECT symbol, timestamp, 'ANOMALY: ' || symbol || ' | type=' || anomaly_type ||
        ' score=' || {number_text('anomaly_score')} || ' | time=' || timestamp || ' | price=' || {number_text('price')} ||
        ' | z=' || {number_text('z_score')} || ' | pct=' || {number_text('price_change_pct')} || ' | vol_spike=' ||
        {number_text('volume_spike')} || ' | source=' || source AS message FROM payloads""",
    "alert_messages_rich": f"""WITH {ROLLED} SELECT trade_id, anomaly_type,
        CASE anomaly_type WHEN 'z_score' THEN '📊' WHEN 'isoforest' THEN '🌳' ELSE '🎯' END || ' **ANOMALY DETECTED**' || chr(10) || chr(10) ||
        '**Type:** ' || CASE anomaly_type WHEN 'z_score' THEN 'Z Score' WHEN 'isoforest' THEN 'Isoforest'
          ELSE 'Filtered Isoforest' END || chr(10) || '**Symbol:** ' || symbol || chr(10) ||
        '**Time:** ' || {iso('event_time')} || chr(10) || '**Price:** $' || format('{{:,.2f}}', price) || chr(10) ||
        '**Z-Score:** ' || format('{{:.2f}}', z_score) || chr(10) ||
        CASE WHEN price_change_pct <> 0 THEN '**Price Change:** ' || format('{{:.2f}}', price_change_pct) || '%' || chr(10) ELSE '' END ||
        CASE WHEN volume_spike > 2 THEN '**Volume Spike:** ' || format('{{:.1f}}', volume_spike) || 'x normal' || chr(10) ELSE '' END ||
        CASE WHEN vwap_deviation <> 0 THEN '**VWAP Deviation:** ' || format('{{:.2f}}', vwap_deviation) || '%' || chr(10) ELSE '' END
        AS message FROM labelled""",
    "alert_method_filter": f"""WITH {ROLLED} SELECT trade_id, anomaly_type FROM labelled
        WHERE anomaly_type IN ('z_score', 'filtered_isoforest')""",
    "alert_outbox": f"""WITH RECURSIVE {COOLDOWN}, sent AS (SELECT symbol, {iso('event_time')} AS timestamp, price, z_score,
          price_change_pct, volume_spike, anomaly_type, abs(z_score) AS anomaly_score, 'dispatcher' AS source
          FROM fold WHERE passes AND anomaly_type IN ('z_score', 'filtered_isoforest'))
        SELECT symbol, timestamp, {r('price')} AS price, {r('z_score')} AS z_score, {r('price_change_pct')} AS price_change_pct,
        {r('volume_spike')} AS volume_spike, anomaly_type, {r('anomaly_score')} AS anomaly_score, source,
        sha1(concat_ws('|', symbol, timestamp, anomaly_type, {number_text('anomaly_score', 3)})) AS alert_key,
        'ANOMALY: ' || symbol || ' | type=' || anomaly_type || ' score=' || {number_text('anomaly_score')} || ' | time=' ||
        timestamp || ' | price=' || {number_text('price')} || ' | z=' || {number_text('z_score')} || ' | pct=' ||
        {number_text('price_change_pct')} || ' | vol_spike=' || {number_text('volume_spike')} || ' | source=' || source
        AS message FROM sent""",
    "ohlcv_1h": f"WITH {TRADES} {candles('1 HOUR', '')}",
    "ohlcv_1d": f"WITH {TRADES} {candles('1 DAY', IS_UP)}",
    "candles_with_anomalies": f"""WITH {ROLLED}, bars AS ({candles('1 DAY', IS_UP)}), marks AS (
        SELECT symbol, date_trunc('day', event_time) AS bucket, count(*) AS anomaly_count, {r('max(abs(z_score))')} AS max_abs_z
        FROM labelled GROUP BY 1, 2) SELECT bars.*, coalesce(anomaly_count, 0) AS anomaly_count, max_abs_z
        FROM bars LEFT JOIN marks ON bars.symbol = marks.symbol AND bars.bucket = CAST(marks.bucket AS TIMESTAMP)""",
    "market_kpis": f"""WITH {ROLLED}, k AS (SELECT symbol, last(price ORDER BY event_time, trade_id) AS cur,
        first(price ORDER BY event_time, trade_id) AS fst, max(price) AS high, min(price) AS low, sum(quantity) AS volume
        FROM trades GROUP BY symbol), a AS (SELECT symbol, count(*) AS c FROM labelled GROUP BY symbol)
        SELECT k.symbol, {r('cur')} AS current_price, {r('(cur - fst) / fst * 100')} AS change_pct, {r('high')} AS high,
        {r('low')} AS low, {r('volume')} AS volume, split_part(k.symbol, '/', 1) AS base_currency,
        coalesce(a.c, 0) AS anomaly_count FROM k LEFT JOIN a ON a.symbol = k.symbol""",
    "symbol_rates": f"""WITH {ROLLED}, j AS (SELECT t.symbol, t.n AS trades, coalesce(a.n, 0) AS anomalies FROM
        (SELECT symbol, count(*) AS n FROM trades GROUP BY symbol) t LEFT JOIN
        (SELECT symbol, count(*) AS n FROM labelled GROUP BY symbol) a ON a.symbol = t.symbol), u AS (
        SELECT symbol, trades, anomalies FROM j UNION ALL SELECT 'TOTAL', sum(trades)::BIGINT, sum(anomalies)::BIGINT FROM j)
        SELECT symbol, trades, anomalies, {r('anomalies::DOUBLE / trades * 100')} AS rate_pct FROM u""",
    "data_coverage": f"""WITH {TRADES} SELECT symbol, min(event_time) AS first_time, max(event_time) AS last_time,
        count(*) AS trades FROM trades GROUP BY symbol""",
    "data_freshness": f"""WITH {TRADES} SELECT max(event_time) AS latest_time,
        {r("(epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(max(event_time))) / 1e6")} AS age_sec FROM trades""",
    "anomaly_types": f"WITH {ROLLED} SELECT DISTINCT anomaly_type FROM labelled ORDER BY 1",
    "lookback_counts": f"""WITH {TRADES} SELECT m.minutes::BIGINT AS minutes, symbol, count(*) AS trades FROM trades,
        (VALUES (10), (15), (60), (240), (1440), (10080)) m(minutes)
        WHERE event_time <= TIMESTAMP '2024-01-30 12:00:00'
        AND event_time >= TIMESTAMP '2024-01-30 12:00:00' - to_minutes(m.minutes) GROUP BY 1, 2""",
    "recent_trades": f"""WITH {TRADES} SELECT trade_id, symbol, event_time, {r('price')} AS price, {r('quantity')} AS quantity
        FROM trades WHERE symbol = 'BTC/USDT' AND event_time <= TIMESTAMP '2024-01-30 12:00:00'
        AND event_time >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 10080 MINUTE ORDER BY event_time DESC""",
    "recent_anomalies": f"""WITH {ROLLED} SELECT trade_id, symbol, event_time, anomaly_type, {r('z_score')} AS z_score
        FROM labelled WHERE anomaly_type IN ('z_score', 'filtered_isoforest')
        AND event_time <= TIMESTAMP '2024-01-30 12:00:00'
        AND event_time >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 20160 MINUTE ORDER BY event_time""",
    "recent_anomaly_board": f"""WITH {ROLLED} SELECT trade_id, strftime(event_time, '%H:%M:%S') AS time, anomaly_type AS type,
        '$' || format('{{:,.2f}}', price) AS price, format('{{:.2f}}', z_score) AS z_score FROM labelled
        ORDER BY event_time DESC, trade_id DESC, anomaly_type LIMIT 20""",
    "latest_trade": f"""WITH {TRADES}, k AS (SELECT *, row_number() OVER (PARTITION BY symbol
        ORDER BY event_time DESC, trade_id DESC) AS n FROM trades)
        SELECT symbol, trade_id, event_time, {r('price')} AS price, {r('quantity')} AS quantity FROM k WHERE n = 1""",
    "symbol_universe": f"WITH {TRADES} SELECT DISTINCT symbol FROM trades ORDER BY symbol",
    "anomaly_trade_join": f"""WITH {ROLLED} SELECT l.trade_id, l.symbol, l.anomaly_type, {r('l.price')} AS price,
        {r('l.z_score')} AS z_score, {r('t.quantity')} AS quantity, t.is_buyer_maker
        FROM labelled l JOIN trades t ON t.trade_id = l.trade_id""",
    "orphan_anomalies": f"""WITH {ROLLED} SELECT trade_id, anomaly_type FROM labelled l
        WHERE NOT EXISTS (SELECT 1 FROM trades t WHERE t.trade_id % 7 <> 0 AND t.trade_id = l.trade_id)""",
    "zscore_bands": f"""WITH {ROLLED} SELECT symbol, trade_id, event_time, {r('z_score')} AS z_score, 3.5e0 AS upper_band,
        -3.5e0 AS lower_band, abs(z_score) > 3.5e0 AS is_breach FROM rolled""",
    "latency_percentiles": f"WITH {TRADES}, {DECIDED} SELECT symbol, {LATENCY} FROM decided GROUP BY symbol",
    "top_symbols": f"""WITH {ROLLED}, {DECIDED}, j AS (SELECT t.symbol, t.n AS trades, coalesce(a.n, 0) AS anomalies, d.p AS p95
        FROM (SELECT symbol, count(*) AS n FROM trades GROUP BY symbol) t
        LEFT JOIN (SELECT symbol, count(*) AS n FROM labelled GROUP BY symbol) a ON a.symbol = t.symbol
        LEFT JOIN (SELECT symbol, quantile_cont(e2e_ms, 0.95) AS p FROM decided GROUP BY symbol) d ON d.symbol = t.symbol)
        SELECT symbol, trades, anomalies, {r(r('anomalies::DOUBLE / trades * 100', 3))} AS detect_rate_pct,
        {r(r('p95', 3))} AS e2e_p95_ms FROM j ORDER BY trades DESC, anomalies DESC, symbol LIMIT 5""",
    "lag_stats": f"""WITH {TRADES}, {LAG} SELECT min(low) AS lag_min, {r('avg(mean)')} AS lag_avg, max(high) AS lag_max FROM lags""",
    "metric_intervals": f"""WITH {TRADES}, {INTERVALS} SELECT interval_start, {r('io_write_ms_avg')} AS io_write_ms_avg,
        bytes_written, refits, {r('refit_time_ms')} AS refit_time_ms FROM intervals""",
    "run_summary": f"""WITH {ROLLED}, {DECIDED}, {LAG}, {INTERVALS},
        c AS (SELECT (SELECT count(*) FROM trades) AS total_trades, (SELECT count(*) FROM labelled) AS total_anomalies),
        e AS (SELECT {LATENCY} FROM decided),
        g AS (SELECT min(low) AS lag_min, {r('avg(mean)')} AS lag_avg, max(high) AS lag_max FROM lags),
        i AS (SELECT {r('avg(io_write_ms_avg)')} AS io_write_ms_avg, sum(bytes_written)::BIGINT AS bytes_written,
              sum(refits)::BIGINT AS refits, {r('sum(refit_time_ms)')} AS refit_time_ms FROM intervals),
        t AS (SELECT {r(r('avg(trade_id % 16) FILTER (trade_id % 5 = 1) / 1e3'))} AS avg_processing_time_sec,
              {r(r('avg(trade_id % 16) FILTER (trade_id % 5 = 2) / 1e3'))} AS avg_detection_time_sec,
              count(*) FILTER (trade_id % 50 = 3) AS total_alerts FROM trades)
        SELECT total_trades, total_anomalies,
        {r(r('total_anomalies::DOUBLE / total_trades * 100'))} AS detection_rate_pct, e.*, g.*, i.*, t.*,
        'check' AS run_id, 'batch' AS env_mode, 3::BIGINT AS partitions FROM c, e, g, i, t""",
    "inject_pct": f"""WITH {TRADES}, h AS (SELECT *, ((trade_id % 1000003) * 7919) % 10007 < 1000 AS hit,
        (((trade_id % 1000003) * 7919 + 104729) % 10007) % 2 = 0 AS up FROM trades)
        SELECT trade_id, {r('CASE WHEN hit THEN greatest(0e0, price * (CASE WHEN up THEN 1.02e0 ELSE 0.98e0 END)) ELSE price END')}
        AS price, hit AS injected FROM h""",
    "inject_spikes": f"""WITH {TRADES}, {SPIKES} SELECT trade_id, {r('price')} AS price, injection_kind, injected
        FROM injected_trades""",
    "injection_counts": f"""WITH {TRADES}, {SPIKES} SELECT symbol, count(*) FILTER (injected) AS injected_trades,
        count(*) AS trades FROM injected_trades GROUP BY symbol""",
    "proxy_label_rate": f"""WITH {ROLLED} SELECT count(*) AS rows, count(*) FILTER (is_z) AS positives,
        {r('avg(CASE WHEN is_z THEN 1e0 ELSE 0e0 END)')} AS anomaly_rate FROM modelled""",
    "confusion_matrix": f"WITH {AGAINST_PROXY} SELECT {CONFUSION_COLUMNS} FROM counted",
    "classification_report": f"""WITH {AGAINST_PROXY} SELECT 'Normal' AS class, {share('tn', 'tn + fn')} AS precision,
        {share('tn', 'tn + fp')} AS recall, {share('2 * tn', '2 * tn + fn + fp')} AS f1, tn + fp AS support FROM counted
        UNION ALL SELECT 'Anomaly', {share('tp', 'tp + fp')}, {share('tp', 'tp + fn')},
        {share('2 * tp', '2 * tp + fp + fn')}, tp + fn FROM counted""",
    "injection_eval": f"""WITH {TRADES}, {BIG_SPIKES}, {rolling('injected_trades', '1e4')},
        judged AS (SELECT injected AS truth, is_z AS predicted FROM modelled WHERE history_length >= 50),
        {confusion('judged')} SELECT {CONFUSION_COLUMNS} FROM counted""",
    "model_fallback": f"""WITH {TRADES}, {SPELLED}, cleaned AS (
          SELECT spelling, replace(trim(upper(spelling)), '-', '/') AS s FROM spelled), named AS (
          SELECT spelling, coalesce(CASE WHEN contains(s, '/') OR length(s) <= 3 THEN s
          ELSE regexp_replace(s, '^(.+)(USDT|USD|USDC|BTC|ETH|BNB)$', '\\1/\\2') END, '') AS n FROM cleaned)
        SELECT spelling AS symbol, CASE WHEN n = 'BTC/USDT' THEN n WHEN n = 'ETH/USDT' THEN 'ETHUSDT' ELSE '_default_' END
        AS model_key, count(*) AS trades FROM named GROUP BY 1, 2""",
    "stream_window_features": f"""WITH {WINDOWED} SELECT symbol, {r('first_price')} AS first_price,
        {r('last_price')} AS last_price, {r('avg_price')} AS avg_price, {r('std_price')} AS std_price,
        {r('window_volume')} AS window_volume, {r('avg_quantity')} AS avg_quantity, {r('max_quantity')} AS max_quantity,
        trade_count, injected_count, min_event_time, max_event_time, {r('price_change_pct')} AS price_change_pct,
        {r('volume_spike')} AS volume_spike, {r('z_score')} AS z_score, time_range_sec,
        {r('time_gap_sec')} AS mean_interarrival_sec, {r('time_gap_sec')} AS time_gap_sec,
        max_event_time AS latest_event_time, window_start, window_end, hour FROM limited WHERE {CLOSED}""",
    "stream_trades_sink": f"""WITH {WINDOWED} SELECT symbol, max_event_time AS timestamp, {r('last_price')} AS price,
        {r('window_volume')} AS window_volume, {r('z_score')} AS z_score, {r('price_change_pct')} AS price_change_pct,
        {r('volume_spike')} AS volume_spike, hour, window_start, window_end, trade_count FROM feats WHERE {CLOSED}""",
    "stream_anomalies_sink": f"""WITH {WINDOWED} SELECT {ANOMALY_COLUMNS}, {r('time_gap_sec')} AS time_gap_sec,
        anomaly_type, {r('anomaly_score')} AS anomaly_score, hour, window_start, window_end,
        {r('if_anomaly_score')} AS if_anomaly_score FROM scored WHERE is_anomaly AND {CLOSED}""",
    "stream_fanout": f"""WITH {WINDOWED} SELECT 'trades' AS "table", symbol, window_start, {r('last_price')} AS price,
        {r('z_score')} AS z_score FROM scored WHERE {CLOSED}
        UNION ALL SELECT 'anomalies', symbol, window_start, {r('last_price')}, {r('z_score')} FROM scored
        WHERE is_anomaly AND {CLOSED}""",
    "stream_rolling_features": f"""WITH {ROLLED} SELECT trade_id, symbol, history_length, {r('rolling_mean')} AS rolling_mean,
        {r('rolling_std')} AS rolling_std, {r('z_score')} AS z_score, {r('vwap')} AS vwap,
        {r('price_velocity')} AS price_velocity, {r('volume_spike')} AS volume_spike, {r('buy_pressure')} AS buy_pressure,
        {r('price_change_pct')} AS price_change_pct, {r('time_gap_sec')} AS time_gap_sec FROM rolled""",
    "stream_cooldown": f"""WITH RECURSIVE {TRADES}, found AS (
          SELECT trade_id, symbol, event_time, CASE WHEN price > 60 THEN 'price' WHEN quantity > 90 THEN 'volume' END AS anomaly_type
          FROM trades),
        {FOLD.format(source='SELECT * FROM found WHERE anomaly_type IS NOT NULL')}
        SELECT trade_id, symbol, event_time, anomaly_type FROM fold WHERE passes""",
    "stream_outbox": f"""WITH {WINDOWED}, payloads AS (
          SELECT symbol, {iso('max_event_time')} AS timestamp, anomaly_type, anomaly_score FROM scored
          WHERE is_anomaly AND {CLOSED})
        SELECT DISTINCT sha1(concat_ws('|', symbol, timestamp, anomaly_type, {number_text('anomaly_score', 3)})) AS alert_key,
        symbol, timestamp, anomaly_type, 'dispatcher' AS source FROM payloads""",
    "stream_observed": f"""WITH {TRADES}, cut AS (SELECT *, floor((epoch_us(event_time) - lo) / ((hi - lo) // 4 + 1))::BIGINT AS batch_id
        FROM trades, (SELECT min(epoch_us(event_time)) AS lo, max(epoch_us(event_time)) AS hi FROM trades)),
        sums AS (SELECT batch_id, count(*)::DOUBLE AS rows, sum(quantity) AS quantity FROM cut GROUP BY batch_id)
        SELECT batch_id, 'rows' AS name, rows AS value FROM sums UNION ALL SELECT batch_id, 'quantity', quantity FROM sums""",
    "stream_refits": f"""WITH {TRADES}, n AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY event_time, trade_id) AS k
        FROM trades), range_ AS (SELECT min(epoch_us(event_time)) AS lo, max(epoch_us(event_time)) AS hi FROM trades)
        SELECT DISTINCT symbol, floor((epoch_us(event_time) - lo) / ((hi - lo) // 4 + 1))::BIGINT AS batch FROM n, range_
        WHERE k = 149 OR (k > 149 AND k % 700 = 0)""",
    "model_versions_asof": f"""WITH {TRADES}, n AS (SELECT *, row_number() OVER (PARTITION BY symbol
        ORDER BY event_time, trade_id) AS k FROM trades), points AS (SELECT symbol, event_time AS valid_from, k AS version FROM n
        WHERE k = 149 OR (k > 149 AND k % 700 = 0))
        SELECT t.trade_id, t.symbol, p.version FROM trades t ASOF LEFT JOIN points p
        ON t.symbol = p.symbol AND t.event_time >= p.valid_from""",
    "clustered_table": f"""WITH {TRADES} SELECT trade_id, symbol, strftime(event_time, '%Y-%m-%d') AS date, event_time,
        {r('price')} AS price, {r('quantity')} AS quantity, is_buyer_maker FROM trades WHERE symbol <> 'XRP/USDT'""",
    "latest_files": f"""WITH {TRADES}, range_ AS (SELECT min(epoch_us(event_time)) AS lo, max(epoch_us(event_time)) AS hi FROM trades)
        SELECT trade_id, symbol, {r('price')} AS price FROM trades, range_
        WHERE floor((epoch_us(event_time) - lo) / ((hi - lo) // 5 + 1)) >= 3""",
    "stream_outbox_files": f"""WITH {WINDOWED}, payloads AS (
          SELECT symbol, {iso('max_event_time')} AS timestamp, anomaly_type, anomaly_score FROM scored WHERE is_anomaly)
        SELECT DISTINCT sha1(concat_ws('|', symbol, timestamp, anomaly_type, {number_text('anomaly_score', 3)})) AS alert_key,
        symbol, timestamp, anomaly_type, 'dispatcher' AS source FROM payloads""",
}
# Over several files as over one.
ORACLE["training_tail_short"] = ORACLE["training_tail"].replace("LIMIT 10000", "LIMIT 300")
ORACLE["anomalies_since_first"] = ORACLE["anomalies_since_top"].replace("LIMIT 200", "LIMIT 40")
ORACLE["stream_rolling_files"] = ORACLE["stream_rolling_features"]
ORACLE["stream_rolling_lanes"] = ORACLE["rolling_features_blocks"]
ORACLE["stream_cooldown_files"] = ORACLE["stream_cooldown"]
