"""Oracle SQL (DuckDB dialect) for every registered query.

The expected results are computed from the *intended* field values of the
bridge (``sources.bridge``), written here a second time in SQL, never from
the rendered text.  A Spark query that parses, routes, loads and aggregates
the text must land on the same numbers.
"""

from __future__ import annotations

# Processing time pinned by the registered queries (where the pipeline would
# otherwise use "now" as a timestamp fallback).
RUN_TS = "2024-02-01 00:00:00"

_FW = """
fw_e AS (
  SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events),
fw AS (
  SELECT event_id AS src_id, CAST(ts AS TIMESTAMP) AS src_ts, user_id, k, value,
    'FG' || lpad(CAST(user_id AS VARCHAR), 4, '0') AS device_id,
    16 + k % 8 AS facility,
    k % 25 = 7 AS prio_bad,
    CAST(event_id % 8 AS INTEGER) AS priority,
    CASE k % 3 WHEN 0 THEN 'traffic' WHEN 1 THEN 'vpn' ELSE 'utm' END AS tag,
    CASE WHEN k % 2 = 0 THEN 'fwd' ELSE 'ipsd' END AS program,
    k % 8 AS ts_kind,
    CASE WHEN k % 8 IN (1, 5) THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
         WHEN k % 8 IN (2, 6) THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ')
         WHEN k % 8 = 3 THEN 'bad'
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts_text,
    CASE WHEN k % 8 = 3 AND k <> 99
         THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') END AS eventtime,
    CASE WHEN k % 20 <> 17 THEN event_type END AS event_type,
    CASE WHEN k % 2 = 0 THEN 'forward' ELSE 'local' END AS subtype,
    CASE event_type WHEN 'error' THEN 'deny' WHEN 'signup' THEN 'fail'
         WHEN 'view' THEN '' ELSE 'accept' END AS action,
    CASE WHEN event_type = 'error' OR k % 10 = 9 THEN 'failed'
         WHEN event_type = 'view' THEN '' ELSE 'success' END AS status,
    CASE WHEN k % 20 = 13 THEN '' ELSE lpad(CAST(event_id AS VARCHAR), 10, '0') END AS logid,
    CASE WHEN k % 6 = 0 THEN 'VPN tunnel down'
         WHEN k % 6 = 3 THEN 'Admin login ok' END AS logdesc,
    '10.0.' || CAST(user_id % 16 AS VARCHAR) || '.' || CAST(k AS VARCHAR) AS srcip,
    '172.16.' || CAST(k % 8 AS VARCHAR) || '.' || CAST(user_id % 32 AS VARCHAR) AS dstip,
    CAST(1024 + event_id % 50000 AS INTEGER) AS srcport,
    CAST(CASE k % 3 WHEN 0 THEN 443 WHEN 1 THEN 53 ELSE 80 END AS INTEGER) AS dstport,
    CAST(CASE k % 4 WHEN 0 THEN 6 WHEN 1 THEN 17 WHEN 2 THEN 1 ELSE 47 END AS INTEGER) AS proto,
    CASE k % 3 WHEN 0 THEN 'HTTPS' WHEN 1 THEN 'DNS' ELSE 'HTTP' END AS service,
    CASE WHEN k % 10 = 0 THEN '' ELSE 'policy-' || CAST(k % 10 AS VARCHAR) END AS policyname,
    CASE WHEN k % 10 = 0 THEN '' WHEN k % 2 = 0 THEN 'policy'
         ELSE 'proxy-policy' END AS policytype,
    CAST(event_id * 7 + 1000 AS VARCHAR) AS sessionid,
    CAST(floor(value * 100) AS BIGINT) AS sentbyte,
    CAST(k * 10 AS BIGINT) AS rcvdbyte,
    CAST(user_id % 4 AS INTEGER) AS vwlid,
    'FGT-' || lpad(CAST(user_id % 100 AS VARCHAR), 3, '0') AS devname,
    CASE WHEN user_id % 3 = 0 THEN '' ELSE 'firewall' END AS devtype,
    CASE WHEN k % 7 = 0 THEN '' ELSE 'vendor' || CAST(k % 3 AS VARCHAR) END AS srchwvendor,
    'aa:bb:cc:' || lpad(CAST(user_id % 100 AS VARCHAR), 2, '0') || ':'
      || lpad(CAST(k AS VARCHAR), 2, '0') || ':00' AS srcmac,
    k % 5 <> 0 AS lat_present,
    CASE WHEN k % 2 = 0 THEN 'text' ELSE 'key' END AS lat_form,
    k % 30 <> 29 AS has_seq,
    k % 50 = 0 AS dup,
    event_id % 1000 = 2 AS bom,
    event_id % 11 = 3 AS port_messy,
    event_id % 13 = 5 AND floor(value * 100) >= 1000 AS bytes_messy,
    CASE WHEN event_id % 3 = 0 THEN CAST(value AS VARCHAR) || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0')
         ELSE CAST(value AS VARCHAR) END AS lat_text
  FROM fw_e),
fwm AS (
  SELECT *, concat_ws(' ',
    CASE WHEN logid <> '' THEN 'logid=' || logid END,
    CASE WHEN event_type IS NOT NULL THEN 'type=' || event_type END,
    'subtype=' || subtype,
    CASE WHEN action <> '' THEN 'action=' || action END,
    CASE WHEN status <> '' THEN 'status=' || status END,
    CASE WHEN logdesc IS NOT NULL THEN 'logdesc=' || logdesc END,
    'srcip=' || srcip, 'dstip=' || dstip,
    'srcport=' || CAST(srcport AS VARCHAR) || CASE WHEN port_messy THEN 'abc' ELSE '' END, 'dstport=' || CAST(dstport AS VARCHAR),
    'proto=' || CAST(proto AS VARCHAR), 'service=' || service,
    CASE WHEN policyname <> '' THEN 'policyname=' || policyname END,
    CASE WHEN policytype <> '' THEN 'policytype=' || policytype END,
    'sessionid=' || sessionid,
    'sentbyte=' || CASE WHEN bytes_messy
      THEN CAST(sentbyte // 1000 AS VARCHAR) || ',' || lpad(CAST(sentbyte % 1000 AS VARCHAR), 3, '0')
      ELSE CAST(sentbyte AS VARCHAR) END, 'rcvdbyte=' || CAST(rcvdbyte AS VARCHAR),
    'vwlid=' || CAST(vwlid AS VARCHAR), 'devname=' || devname,
    CASE WHEN devtype <> '' THEN 'devtype=' || devtype END,
    CASE WHEN srchwvendor <> '' THEN 'srchwvendor=' || srchwvendor END,
    'srcmac=' || srcmac,
    CASE WHEN eventtime IS NOT NULL THEN 'eventtime=' || eventtime END,
    CASE WHEN lat_present AND lat_form = 'text' THEN 'latency: ' || lat_text END,
    CASE WHEN lat_present AND lat_form = 'key' THEN 'latency=' || lat_text END
  ) AS clean_msg FROM fw),
fwl AS (
  SELECT *, src_id * 4 AS line_no FROM fwm
  UNION ALL
  SELECT *, src_id * 4 + 1 AS line_no FROM fwm WHERE dup
  UNION ALL  -- a line without msg: every message field has its default
  SELECT * REPLACE ('' AS clean_msg, NULL AS event_type, '' AS subtype, '' AS action, '' AS status,
      '' AS logid, NULL AS logdesc, NULL AS eventtime, '' AS srcip, '' AS dstip,
      CAST(0 AS INTEGER) AS srcport, CAST(0 AS INTEGER) AS dstport, CAST(0 AS INTEGER) AS proto,
      '' AS service, '' AS policyname, '' AS policytype, '' AS sessionid, CAST(0 AS BIGINT) AS sentbyte,
      CAST(0 AS BIGINT) AS rcvdbyte, CAST(0 AS INTEGER) AS vwlid, '' AS devname, '' AS devtype,
      '' AS srchwvendor, '' AS srcmac, FALSE AS lat_present, FALSE AS port_messy, FALSE AS bytes_messy,
      TRUE AS has_seq, FALSE AS bom), src_id * 4 + 3 AS line_no
  FROM fwm WHERE src_id % 500 = 3),
fwb0 AS (
  SELECT *, CASE WHEN prio_bad THEN 0 ELSE priority END AS bprio,
            CASE WHEN prio_bad THEN 7 ELSE priority END AS rprio FROM fwl),
fwb1 AS (
  SELECT *,
    CAST(CASE WHEN bprio <= 2 THEN 5 WHEN bprio = 3 THEN 4 WHEN bprio = 4 THEN 3
              WHEN bprio = 5 THEN 2 ELSE 1 END AS INTEGER) AS b_sev,
    CASE WHEN bprio <= 2 THEN 'critical' WHEN bprio = 3 THEN 'error'
         WHEN bprio = 4 THEN 'warning' WHEN bprio = 5 THEN 'info' ELSE 'ok' END AS b_label,
    CAST(CASE WHEN rprio <= 2 THEN 5 WHEN rprio = 3 THEN 4 WHEN rprio = 4 THEN 3
              ELSE 2 END AS INTEGER) AS r_sev,
    CASE WHEN rprio <= 2 THEN 'critical' WHEN rprio = 3 THEN 'error'
         WHEN rprio = 4 THEN 'warning' ELSE 'info' END AS r_label
  FROM fwb0),
fwb AS (
  SELECT line_no, src_id, src_ts, ts_kind, k,
    logid AS event_id, device_id, ts_text AS ts, coalesce(eventtime, '') AS eventtime,
    CASE WHEN logdesc IS NOT NULL THEN split_part(logdesc, ' ', 1)
         ELSE substr(clean_msg, 1, 200) END AS message,
    tag, program,
    CASE WHEN has_seq THEN CAST(src_id AS VARCHAR) ELSE '0' END AS seq,
    coalesce(event_type, 'unknown') AS event_type, subtype, action, status,
    srcip, dstip, srcport, dstport, proto, service, policyname, policytype,
    '' AS poluuid, sentbyte, rcvdbyte, sentbyte + rcvdbyte AS total_bytes,
    CASE WHEN lat_present AND lat_form = 'text' THEN CAST(lat_text AS REAL)
         ELSE CAST(0 AS REAL) END AS latency,
    sessionid, vwlid, '' AS vwlquality, devname, devtype, srchwvendor, srcmac,
    b_sev AS severity, b_label AS severity_label,
    CAST((status = 'failed' OR action IN ('deny', 'fail') OR b_sev >= 4) AS INTEGER) AS is_anomaly
  FROM fwb1),
fwr AS (
  SELECT line_no, src_id, src_ts, ts_kind, k,
    'fw-' || CAST(line_no AS VARCHAR) AS event_id,
    CASE WHEN bom THEN chr(65279) || device_id ELSE device_id END AS device_id,
    ts_text AS ts, program, tag, action, status, srcip, dstip,
    CASE WHEN port_messy THEN CAST(0 AS INTEGER) ELSE srcport END AS srcport, dstport,
    CASE WHEN bytes_messy THEN CAST(0 AS BIGINT) ELSE sentbyte END AS sentbyte, rcvdbyte,
    CASE WHEN bytes_messy THEN rcvdbyte ELSE sentbyte + rcvdbyte END AS total_bytes,
    CASE WHEN lat_present AND lat_form = 'key' THEN CAST(lat_text AS REAL)
         ELSE CAST(0 AS REAL) END AS latency,
    CAST(facility AS INTEGER) AS facility_raw, r_sev AS severity, r_label AS severity_label,
    CAST((status = 'failed' OR action IN ('deny', 'fail') OR r_sev >= 4) AS INTEGER) AS is_anomaly,
    clean_msg AS message,
    CASE WHEN ts_kind = 3 THEN TIMESTAMP '__RUN_TS__'
         ELSE date_trunc('second', src_ts) END AS ts_loaded
  FROM fwb1),
fwt AS (
  SELECT fwb.*,
    (devtype <> '') AS t_dev,
    (sentbyte > 0 OR rcvdbyte > 0 OR latency > 0) AS t_perf,
    (is_anomaly = 1) AS t_sec,
    (action = 'accept' AND status = 'success') AS t_traf,
    CASE WHEN devtype <> '' THEN 'fg_device_inventory'
         WHEN sentbyte > 0 OR rcvdbyte > 0 OR latency > 0 THEN 'fg_performance'
         ELSE 'fg_raw_all' END AS first_topic
  FROM fwb),
fws0 AS (
  SELECT * EXCLUDE (rn) REPLACE (trim(message) AS message),
    CASE WHEN ts_kind IN (2, 6) OR (ts_kind = 3 AND eventtime <> '')
           THEN date_trunc('millisecond', src_ts)
         WHEN ts_kind = 3 THEN TIMESTAMP '__RUN_TS__'
         ELSE date_trunc('second', src_ts) END AS event_time
  FROM (SELECT *, row_number() OVER (PARTITION BY device_id, ts, seq, event_id ORDER BY line_no) AS rn FROM fwt)
  WHERE rn = 1),
fws AS (
  SELECT *, hour(event_time) AS hour_of_day, dayofweek(event_time) + 1 AS day_of_week,
    CASE proto WHEN 6 THEN 'TCP' WHEN 17 THEN 'UDP' WHEN 1 THEN 'ICMP'
         ELSE CAST(proto AS VARCHAR) END AS proto_label,
    CASE WHEN latency = 0 THEN 'no_data' WHEN latency < 5 THEN 'excellent'
         WHEN latency < 20 THEN 'good' WHEN latency < 50 THEN 'degraded'
         ELSE 'critical' END AS latency_bucket,
    CAST(regexp_matches(message, '(?i)IPsec|IKE|VPN') AND status = 'failed' AS INTEGER)
      AS is_vpn_failure
  FROM fws0)
""".replace("__RUN_TS__", RUN_TS)

_NET = """
nw_e AS (
  SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events),
nw0 AS (
  SELECT event_id AS src_id, CAST(ts AS TIMESTAMP) AS src_ts, k, k % 10 AS kind,
    'SW' || lpad(CAST(user_id % 50 AS VARCHAR), 3, '0') AS device_id,
    event_type AS program,
    '10.1.' || CAST(user_id % 16 AS VARCHAR) || '.' || CAST(k AS VARCHAR) AS ip1,
    '10.2.' || CAST(k AS VARCHAR) || '.' || CAST(user_id % 16 AS VARCHAR) AS ip2,
    'aa:bb:cc:00:' || lpad(CAST(user_id % 100 AS VARCHAR), 2, '0') || ':'
      || lpad(CAST(k AS VARCHAR), 2, '0') AS mac,
    user_id % 8 AS slot, user_id % 48 AS port,
    CASE WHEN k % 25 = 24 THEN 'n/a' ELSE strftime(ts, '%d/%m/%Y %H:%M') END AS raw_ts,
    k % 33 <> 32 AS has_msg
  FROM nw_e),
nw1 AS (
  SELECT *,
    CASE WHEN NOT has_msg THEN ''
      WHEN kind = 0 THEN 'dhcp lease ' || ip1 || ' to ' || mac
      WHEN kind = 1 THEN 'DHCPACK on ' || ip1 || ' to ' || replace(mac, ':', '-') || ' via ' || ip2
      WHEN kind = 2 THEN 'WLAN station join ' || mac
      WHEN kind = 3 THEN 'IP_CONFLICT ' || ip1 || ' with ' || ip2 || ' ' || mac
      WHEN kind = 4 THEN 'USER_OFFLINE ' || ip1
      WHEN kind = 5 THEN 'arp who-has ' || ip2 || ' tell ' || ip1
      WHEN kind = 6 THEN 'BGP neighbor ' || ip2 || ' Down'
      WHEN kind = 7 THEN 'FEI_COMM link lost on slot ' || CAST(slot AS VARCHAR)
      WHEN kind = 8 THEN 'STATUS changed on port ' || CAST(port AS VARCHAR)
      ELSE 'user_offline ' || ip1 || ' timeout' END AS msg,
    CASE WHEN NOT has_msg THEN 'unknown'
      WHEN kind IN (0, 1) THEN 'dhcp' WHEN kind IN (2, 8) THEN 'wlan'
      WHEN kind = 3 THEN 'ip_conflict' WHEN kind = 4 THEN 'user_offline'
      WHEN kind = 5 THEN 'arp' WHEN kind = 6 THEN 'bgp' WHEN kind = 7 THEN 'sync'
      ELSE 'unknown' END AS log_type,
    CASE WHEN NOT has_msg THEN '' WHEN kind IN (0, 1, 3, 4, 9) THEN ip1
      WHEN kind IN (5, 6) THEN ip2 ELSE '' END AS src_ip,
    CASE WHEN NOT has_msg THEN '' WHEN kind IN (1, 3) THEN ip2
      WHEN kind = 5 THEN ip1 ELSE '' END AS dst_ip,
    CASE WHEN NOT has_msg THEN '' WHEN kind IN (0, 2, 3) THEN mac
      WHEN kind = 1 THEN replace(mac, ':', '-') ELSE '' END AS mac_address
  FROM nw0),
nw AS (
  SELECT src_id, src_id * 2 + 1 AS line_no,
    'NET-' || device_id || '-' || CAST(src_id * 2 + 1 AS VARCHAR) AS event_id,
    device_id,
    CASE WHEN raw_ts = 'n/a' THEN TIMESTAMP '__RUN_TS__'
         ELSE date_trunc('minute', src_ts) END AS ts_value,
    program, log_type,
    'timestamp=' || raw_ts || ' | device_id=' || device_id || ' | program=' || program
      || ' | msg=' || msg AS message,
    src_ip, dst_ip, mac_address
  FROM nw1),
nwt AS (
  SELECT *, strftime(ts_value, '%Y-%m-%d %H:%M:%S') AS ts,
    CAST(length(message) AS BIGINT) AS raw_length FROM nw)
""".replace("__RUN_TS__", RUN_TS)


def fw(body: str) -> str:
    return "WITH " + _FW.strip() + "\n" + body.strip()


def net(body: str) -> str:
    return "WITH " + _NET.strip() + "\n" + body.strip()


def both(body: str) -> str:
    return "WITH " + _FW.strip() + ",\n" + _NET.strip() + "\n" + body.strip()
