"""The registered queries as SQL for DuckDB, written from the definitions, not from the plans."""

SCALE = 360
STRETCH = 28_800

# --- alerts ---------------------------------------------------------------------------------

RAW = """
raw AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS eid, epoch_us(ts) AS ts_us, ts, user_id, event_type, props,
    CAST(event_id % 16 AS INTEGER) AS level,
    CASE event_type WHEN 'error' THEN '5710' WHEN 'signup' THEN '100300' WHEN 'purchase' THEN '100201'
      WHEN 'click' THEN '100200' WHEN 'view' THEN '530' END AS rule_id,
    CASE event_type WHEN 'error' THEN ['syslog','sshd','authentication_failed']
      WHEN 'signup' THEN ['windows','privilege_escalation','windows_security']
      WHEN 'purchase' THEN ['recon','port_scan','pfsense'] WHEN 'click' THEN ['firewall','pfsense']
      WHEN 'view' THEN ['ossec'] END AS groups,
    event_type || ' by user ' || user_id AS description,
    CASE WHEN user_id % 10 = 0 THEN NULL WHEN user_id % 3 = 0 THEN '203.0.113.' || (user_id % 250)
      ELSE '192.168.20.' || (user_id % 250) END AS srcip,
    CAST(event_id % 64511 + 1024 AS VARCHAR) AS srcport,
    json_extract_string(props, '$.k') AS dstport,
    lpad(CAST(event_id % 11 AS VARCHAR), 3, '0') AS agent_id,
    CASE event_id % 11 WHEN 0 THEN 'wazuh-manager' WHEN 1 THEN 'web-srv-01' WHEN 2 THEN 'db-srv-01'
      WHEN 3 THEN 'win-srv-2022-01' WHEN 4 THEN 'ubuntu-' || (event_id % 7)
      ELSE 'host-' || ((event_id // 11) % 40) END AS agent_name,
    CASE event_id % 11 WHEN 0 THEN '192.168.10.10' WHEN 1 THEN '192.168.10.21' WHEN 2 THEN '192.168.10.22'
      WHEN 3 THEN '192.168.10.30' ELSE '10.0.0.' || (event_id % 200) END AS agent_ip,
    CASE WHEN event_type = 'view' THEN '' ELSE 'user ' || user_id || ' ' || event_type || ' '
      || repeat('attempt ', event_id % 15) || props END AS full_log
  FROM events
),
assets(hostname, ip_address, os, role, site, criticality, owner) AS (VALUES
  ('wazuh-manager','192.168.10.10','Ubuntu 24.04','siem-server','haouaria',3,'SOC'),
  ('web-srv-01','192.168.10.21','Ubuntu 22.04','web-server','haouaria',2,'IT'),
  ('db-srv-01','192.168.10.22','Ubuntu 22.04','db-server','haouaria',3,'IT'),
  ('win-srv-2022-01','192.168.10.30','Windows Server 2022','file-server','haouaria',2,'IT'),
  ('workstation-01','192.168.20.11','Windows 10','workstation','haouaria',1,'IT')
),
alerts AS (
  SELECT raw.*,
    CASE WHEN level <= 0 THEN 'info' WHEN level <= 2 THEN 'low' WHEN level <= 4 THEN 'medium'
      WHEN level <= 6 THEN 'high' ELSE 'critical' END AS severity,
    array_to_string(groups, ', ') AS category,
    coalesce(srcip, 'unknown') AS source_ip,
    coalesce(hostname, 'unknown') AS asset_host, coalesce(criticality, 1) AS criticality,
    coalesce(role, 'unknown') AS role
  FROM raw LEFT JOIN assets ON agent_ip = ip_address
)"""

RULES = """
rules(rule_id, rule_name, description, window_sec, threshold, severity, class) AS (VALUES
  ('CORR-001','Brute Force Detection','Multiple authentication failures from the same source IP within a short window',60*360,5,'high','brute_force'),
  ('CORR-002','Privilege Escalation Burst','Repeated privilege-related high severity alerts from the same host',120*360,3,'critical','privilege_escalation'),
  ('CORR-003','Lateral Movement','Same source IP triggering alerts on multiple distinct destination hosts',300*360,3,'critical','lateral_movement'),
  ('CORR-004','Alert Storm','Abnormally high volume of alerts from a single agent',60*360,20,'medium','alert_storm'),
  ('CORR-005','Repeated High Severity','Multiple high or critical severity alerts from the same host in a short period',180*360,3,'high','malware_activity'),
  ('CORR-006','Reconnaissance/ port scan','pfsense port scan confirmed by wazuh frequency correlation (rule 100201)',30*360,1,'high','reconnaissance')
),
matches AS (
  SELECT 'CORR-001' AS rule_id, 'brute_force:' || source_ip AS key, ts_us, eid, agent_name FROM alerts
  WHERE rule_id IN ('60104','60106','5710','5712','2501','2502') OR contains(category, 'authentication_failed')
    OR contains(category, 'brute_force')
  UNION ALL SELECT 'CORR-002', 'priv_esc:' || agent_name, ts_us, eid, agent_name FROM alerts
  WHERE severity IN ('high','critical') AND (contains(category,'privilege') OR contains(category,'escalation') OR contains(category,'sudo'))
  UNION ALL SELECT 'CORR-003', 'lateral:' || source_ip, ts_us, eid, agent_name FROM alerts
  WHERE source_ip <> 'unknown' AND severity IN ('medium','high','critical')
  UNION ALL SELECT 'CORR-004', 'alert_storm:' || agent_name, ts_us, eid, agent_name FROM alerts
  UNION ALL SELECT 'CORR-005', 'high_sev:' || agent_name, ts_us, eid, agent_name FROM alerts WHERE severity IN ('high','critical')
  UNION ALL SELECT 'CORR-006', 'recon:' || source_ip, ts_us, eid, agent_name FROM alerts WHERE rule_id = '100201'
)"""

COUNTED = """
gaps AS (
  SELECT m.*, r.threshold, r.window_sec,
    CASE WHEN ts_us - lag(ts_us) OVER (PARTITION BY m.rule_id, key ORDER BY ts_us, eid) > r.window_sec * 1000000::BIGINT
      THEN 1 ELSE 0 END AS brk
  FROM matches m JOIN rules r ON r.rule_id = m.rule_id WHERE m.rule_id <> 'CORR-003'
),
sessions AS (SELECT *, sum(brk) OVER (PARTITION BY rule_id, key ORDER BY ts_us, eid) AS sid FROM gaps),
numbered AS (SELECT *, row_number() OVER (PARTITION BY rule_id, key, sid ORDER BY ts_us, eid) AS n FROM sessions)"""

DISTINCT = """
lateral_rows AS (
  SELECT key, ts_us, eid, agent_name AS member, row_number() OVER (PARTITION BY key ORDER BY ts_us, eid) AS rn
  FROM matches WHERE rule_id = 'CORR-003'
),
walk AS (
  SELECT key, rn, ts_us, eid, [member] AS seen, false AS fired FROM lateral_rows WHERE rn = 1
  UNION ALL
  SELECT key, rn, ts_us, eid, CASE WHEN len(s) >= 3 THEN [] ELSE s END, len(s) >= 3
  FROM (
    SELECT m.key, m.rn, m.ts_us, m.eid,
      list_distinct(list_append(CASE WHEN m.ts_us - w.ts_us > 300 * 360 * 1000000::BIGINT THEN [] ELSE w.seen END, m.member)) AS s
    FROM walk w JOIN lateral_rows m ON m.key = w.key AND m.rn = w.rn + 1)
)"""

FIRED = """
fired AS (
  SELECT rule_id, key, eid, ts_us FROM numbered WHERE n % threshold = 0
  UNION ALL SELECT 'CORR-003', key, eid, ts_us FROM walk WHERE fired
)"""

INCIDENTS = """
incidents AS (
  SELECT md5(f.rule_id || '|' || f.key || '|' || f.eid) AS id, f.rule_id, f.key, r.rule_name, r.threshold, r.window_sec,
    r.description, r.severity AS severity_text, a.event_id, f.ts_us, make_timestamp(f.ts_us) AS created_at,
    CASE r.severity WHEN 'medium' THEN 1 WHEN 'high' THEN 2 WHEN 'critical' THEN 3 ELSE 0 END AS severity,
    r.class AS category, r.class AS attack_class, round((a.event_id % 101) / 100.0::DOUBLE, 4) AS confidence,
    (a.event_id % 101) / 100.0::DOUBLE >= 0.6::DOUBLE AND r.class <> 'normal_activity' AS is_tp, 'open' AS status,
    r.threshold AS event_count, a.source_ip, a.agent_name AS host, a.agent_ip, a.agent_id, a.rule_id AS alert_rule,
    a.severity AS alert_severity, a.category AS alert_category, a.description AS alert_text, a.role,
    a.criticality, a.asset_host, a.srcport,
    CASE WHEN a.source_ip = 'unknown' THEN NULL ELSE a.source_ip END AS source_ips
  FROM fired f JOIN rules r ON r.rule_id = f.rule_id JOIN alerts a ON a.eid = f.eid
)"""

STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"


def stamp(column: str) -> str:
    return STAMP.format(column)


def _with(*parts: str) -> str:
    return "WITH RECURSIVE " + ",".join(parts)


ALERTS = _with(RAW)
MATCHED = _with(RAW, RULES)
ALL_FIRED = _with(RAW, RULES, COUNTED, DISTINCT, FIRED)
ALL = _with(RAW, RULES, COUNTED, DISTINCT, FIRED, INCIDENTS)

# --- feed -----------------------------------------------------------------------------------

# Text of a feed line, with null fields left out and in the order of the alert's fields.
LINES = """
texts AS (
  SELECT *, event_id % 13 AS kind,
    '{' || CASE WHEN event_id % 13 = 1 THEN '' ELSE '"id":"' || eid || '",' END
    || '"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00",'
    || '"rule":{"id":"' || rule_id || '","level":"' || CASE WHEN event_id % 13 = 2 THEN 'severe' ELSE CAST(level AS VARCHAR) END
    || '","description":"' || description || '","groups":["' || array_to_string(groups, '","') || '"]},'
    || '"agent":{"id":"' || agent_id || '","name":"' || agent_name || '","ip":"' || agent_ip || '"},'
    || '"full_log":"' || replace(full_log, '"', '\\"') || '",'
    || '"data":{' || CASE WHEN srcip IS NULL THEN '' ELSE '"srcip":"' || srcip || '",' END
    || '"srcport":"' || srcport || '","dstport":"' || dstport || '"'
    || CASE WHEN event_type = 'error' THEN ',"dstuser":"user' || user_id || '"' ELSE '' END || '}}' AS json
  FROM raw
)"""

WHITE = "chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"

# --- labels ---------------------------------------------------------------------------------

LABELLED = """
runs AS (
  SELECT c_custkey AS run_idx, upper(substr(c_mktsegment, 1, 4)) || '-0' || (c_custkey % 6) AS scenario_id,
    ['brute_force','reconnaissance','alert_storm','lateral_movement','privilege_escalation','benign'][c_custkey % 6 + 1] AS attack_class,
    CASE WHEN c_custkey % 7 = 0 THEN '' ELSE '192.168.20.' || (c_custkey % 25) END AS target,
    1704067200 + (c_custkey * 7919) % 2592000 AS start_s,
    1704067200 + (c_custkey * 7919) % 2592000 + 60 + (c_custkey * 31) % 2340 AS end_s
  FROM customer
),
ranked AS (
  SELECT raw.*, attack_class AS label, scenario_id,
    scenario_id || '__' || strftime(make_timestamp(start_s * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS run_id,
    row_number() OVER (PARTITION BY event_id ORDER BY
      CASE WHEN coalesce(srcip, '') <> '' AND target <> '' AND contains(srcip, target) THEN 0 ELSE 1 END, run_idx) AS pick
  FROM raw JOIN runs ON ts_us BETWEEN start_s * 1000000 - 5000000 AND end_s * 1000000 + 5000000
),
labelled AS (
  SELECT label, scenario_id, run_id, rule_id, CAST(level AS VARCHAR) AS rule_level, description AS rule_description,
    array_to_string(groups, '|') AS rule_groups, agent_id, agent_name, coalesce(srcip, '') AS srcip,
    CASE WHEN event_type = 'error' THEN 'user' || user_id ELSE '' END AS dstuser,
    CASE WHEN ts_us % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END || '+00:00' AS "timestamp",
    eid AS event_id, event_id AS event_no
  FROM ranked WHERE pick = 1
)"""

PREDICTED = """
predicted AS (
  SELECT *, CASE rule_id WHEN '5710' THEN 'brute_force' WHEN '100201' THEN 'reconnaissance'
    WHEN '100300' THEN 'privilege_escalation' WHEN '100200' THEN 'alert_storm' WHEN '530' THEN 'benign' END AS prediction,
    (event_no % 101) / 100.0::DOUBLE AS prob
  FROM labelled
),
classes AS (SELECT DISTINCT label FROM labelled),
per_class AS (
  SELECT c.label, support, hits, guessed,
    CASE WHEN guessed > 0 THEN hits::DOUBLE / guessed ELSE 0.0 END AS "precision",
    CASE WHEN support > 0 THEN hits::DOUBLE / support ELSE 0.0 END AS recall,
    CASE WHEN guessed + support > 0 THEN 2.0::DOUBLE * hits / (guessed + support) ELSE 0.0 END AS f1
  FROM (SELECT label,
      (SELECT count(*) FROM predicted p WHERE p.label = classes.label) AS support,
      (SELECT count(*) FROM predicted p WHERE p.prediction = classes.label) AS guessed,
      (SELECT count(*) FROM predicted p WHERE p.label = classes.label AND p.prediction = p.label) AS hits
    FROM classes) c
)"""

SPLIT = """
run_ranks AS (
  SELECT run_id, row_number() OVER (ORDER BY md5('42:' || run_id)) AS rk, count(*) OVER () AS n
  FROM (SELECT DISTINCT run_id FROM labelled)
),
run_splits AS (
  SELECT run_id, CASE WHEN rk <= ceil(0.15::DOUBLE * n) THEN 'test'
    WHEN rk <= ceil(0.15::DOUBLE * n) + ceil(0.176::DOUBLE * (n - ceil(0.15::DOUBLE * n))) THEN 'val' ELSE 'train' END AS split
  FROM run_ranks
)"""

LABELS = _with(RAW, LABELLED)
PREDICTIONS = _with(RAW, LABELLED, PREDICTED)
SPLITS = _with(RAW, LABELLED, PREDICTED, SPLIT)

# --- firewall -------------------------------------------------------------------------------

FIREWALL = """
fw AS (
  SELECT eid, event_id, ts_us, 'em' || (user_id % 2) AS interface, 'match' AS reason,
    CASE WHEN event_type = 'view' THEN 'pass' ELSE 'block' END AS action,
    CASE WHEN event_id % 9 < 3 THEN '17' ELSE '6' END AS protocol_id,
    CASE WHEN event_id % 9 < 3 THEN 'udp' ELSE 'tcp' END AS protocol,
    '203.0.113.' || (user_id % 250) AS srcip, '192.168.10.' || (event_id % 200) AS dstip, srcport, dstport
  FROM raw WHERE event_type <> 'error' AND event_id % 9 <> 0
)"""

SCANS = f"""
blocked AS (SELECT * FROM fw WHERE action = 'block'),
dense AS (
  SELECT srcip, event_id, ts_us, row_number() OVER (PARTITION BY srcip ORDER BY ts_us, event_id) AS rn
  FROM (SELECT b.*, (SELECT count(DISTINCT o.dstport) FROM blocked o WHERE o.srcip = b.srcip
      AND o.ts_us BETWEEN b.ts_us - {30 * STRETCH * 1_000_000} AND b.ts_us) AS ports FROM blocked b)
  WHERE ports >= 10
),
steps AS (
  SELECT srcip, event_id, ts_us, rn, ts_us AS last_fire, true AS fired FROM dense WHERE rn = 1
  UNION ALL
  SELECT d.srcip, d.event_id, d.ts_us, d.rn,
    CASE WHEN d.ts_us - s.last_fire > {60 * STRETCH * 1_000_000} THEN d.ts_us ELSE s.last_fire END,
    d.ts_us - s.last_fire > {60 * STRETCH * 1_000_000}
  FROM steps s JOIN dense d ON d.srcip = s.srcip AND d.rn = s.rn + 1
)"""

_SCAN_SQL = _with(RAW, FIREWALL, SCANS) + """
SELECT event_id, ts_us, srcip, '100201' AS rule_id, 10 AS level,
  'pfSense: Possible port scan - ' || srcip || ' hit 10+ distinct ports in ' || (30 * 28800) || 's' AS description FROM steps WHERE fired"""

ATTACK_TEXT = """CASE attack_class WHEN 'brute_force' THEN 'Force Brute' WHEN 'privilege_escalation' THEN 'Escalade de Privilèges'
  WHEN 'lateral_movement' THEN 'Mouvement Latéral' WHEN 'alert_storm' THEN 'Tempête d''Alertes'
  WHEN 'reconnaissance' THEN 'Reconnaissance' WHEN 'data_exfiltration' THEN 'Exfiltration de Données'
  WHEN 'malware_activity' THEN 'Activité Malware' WHEN 'normal_activity' THEN 'Activité Normale' END"""
SEV = "CASE severity WHEN 0 THEN 'info' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' WHEN 3 THEN 'critical' ELSE 'unknown' END"
SEV_FR = "CASE severity WHEN 0 THEN 'Info' WHEN 1 THEN 'Moyen' WHEN 2 THEN 'Élevé' WHEN 3 THEN 'Critique' ELSE 'Inconnu' END"

_FLAT_INCIDENTS = ALL + f"""
SELECT id AS incident_id, {stamp('created_at')} AS ts, rule_id, rule_name, threshold, window_sec,
  severity_text AS severity, status, key AS correlation_key, event_count, host, source_ip, alert_rule, alert_severity, role
FROM incidents"""

_LIST_COLUMNS = f"""id, {stamp('created_at')} AS created_at, severity, category, confidence, status, event_count,
  source_ips, host AS target_hosts, {stamp('created_at')} AS first_seen, {stamp('created_at')} AS last_seen,
  CAST(NULL AS VARCHAR) AS assigned_to, rule_id, rule_name, attack_class, CAST(is_tp AS VARCHAR) AS is_true_positive,
  {SEV} AS severity_label, {SEV_FR} AS severity_fr"""

_FOLDED = f"""
repeated AS (SELECT *, md5(rule_id || '|' || key || '|' || strftime(created_at, '%Y-%m-%d')) AS sid FROM incidents)"""


def _timeline(interval: str, unit: str, label: str) -> str:
    return ALL + f"""
SELECT strftime(b, '{label}') AS label, count(*) AS total, count(*) FILTER (WHERE severity = 3) AS critical,
  count(*) FILTER (WHERE severity = 2) AS high, count(*) FILTER (WHERE severity = 1) AS medium
FROM (SELECT date_trunc('{unit}', created_at) AS b, severity FROM incidents
  WHERE created_at >= (SELECT max(created_at) FROM incidents) - INTERVAL {interval}) GROUP BY b"""


def _rule(rule: str) -> str:
    return ALL_FIRED + f"\nSELECT rule_id, key, eid AS event_id, ts_us FROM fired WHERE rule_id = '{rule}'"


ORACLE: dict[str, str] = {
    "q_ingest": _with(RAW, LINES) + """
SELECT coalesce(CASE WHEN kind = 1 THEN NULL ELSE eid END, sha256(json)) AS _event_id, 'wazuh' AS _source,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "timestamp", rule_id, CAST(level AS VARCHAR) AS level,
  agent_name, srcip FROM texts WHERE kind NOT IN (2, 3, 4)""",
    "q_deadletter": _with(RAW, LINES) + f"""
SELECT 'level' AS reason, md5(json) AS digest, length(json) AS chars FROM texts WHERE kind = 2
UNION ALL SELECT 'malformed', md5(left(json, length(json) - 1)), length(json) - 1 FROM texts WHERE kind = 3
UNION ALL SELECT 'malformed', md5(trim(text, {WHITE})), length(trim(text, {WHITE})) FROM documents
  WHERE trim(text, {WHITE}) <> ''""",
    "q_retention": """
WITH k(dataset, days) AS (VALUES ('alerts_raw', 1), ('alerts_parsed', 2), ('alerts_normalized', 7),
  ('alerts_enriched', 7), ('incidents', 30), ('results', 30))
SELECT dataset, (SELECT count(*) FROM events WHERE ts >= (SELECT max(ts) FROM events) - to_days(k.days)) AS kept FROM k""",
    "q_seed": _with(RAW) + """
SELECT * FROM assets UNION ALL
SELECT agent_name, min(agent_ip), NULL, NULL, 'lab', 1, NULL FROM raw
WHERE agent_name NOT IN (SELECT hostname FROM assets) GROUP BY agent_name""",
    "q_normalize": ALERTS + f"""
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS ts_text, {stamp('ts')} AS event_ts, eid AS event_id,
  'wazuh' AS module, CASE WHEN level >= 2 THEN 'security' ELSE 'process' END AS event_category, severity,
  description AS reason, agent_name AS host_name, agent_ip AS host_ip,
  CASE WHEN contains(lower(agent_name), 'ubuntu') THEN 'linux' WHEN contains(lower(agent_name), 'win') THEN 'windows'
    ELSE 'unknown' END AS os, level, rule_id, category AS rule_category, source_ip, srcport AS source_port,
  'unknown' AS destination_ip, dstport AS destination_port FROM alerts""",
    "q_template": ALERTS + "\nSELECT left(full_log, 100) AS log_template, count(*) AS n FROM alerts GROUP BY 1",
    "q_enrich": ALERTS + "\nSELECT eid AS event_id, agent_ip AS host_ip, asset_host, criticality, role FROM alerts",
    "q_match_matrix": MATCHED + """
SELECT r.rule_id, count(m.rule_id) AS matched FROM rules r LEFT JOIN matches m ON m.rule_id = r.rule_id GROUP BY r.rule_id""",
    **{f"q_corr_{i:03d}": _rule(f"CORR-{i:03d}") for i in range(1, 7)},
    "q_incidents": _FLAT_INCIDENTS,
    "q_incidents_split": _FLAT_INCIDENTS,
    "q_open_counts": _with(RAW, RULES, COUNTED) + """
SELECT rule_id, key, CAST(CASE WHEN (SELECT max(epoch_us(ts)) FROM events) - ts_us > window_sec * 1000000::BIGINT THEN 0
  ELSE n % threshold END AS BIGINT) AS open_count
FROM numbered QUALIFY row_number() OVER (PARTITION BY rule_id, key ORDER BY ts_us DESC, eid DESC) = 1""",
    "q_counters": ALL_FIRED + """
SELECT r.rule_id, (SELECT count(*) FROM matches m WHERE m.rule_id = r.rule_id) AS matched,
  (SELECT count(*) FROM fired f WHERE f.rule_id = r.rule_id) AS fired FROM rules r""",
    "q_features": ALL + """
SELECT id AS incident_id, CAST(right(rule_id, 1) AS INTEGER) AS f_rule_id,
  CASE severity_text WHEN 'info' THEN 0 WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 WHEN 'critical' THEN 4 END AS f_severity,
  event_count AS f_event_count, window_sec AS f_window_sec, threshold AS f_threshold, criticality AS f_asset_criticality,
  CASE role WHEN 'workstation' THEN 1 WHEN 'web-server' THEN 2 WHEN 'file-server' THEN 3 WHEN 'db-server' THEN 4
    WHEN 'siem-server' THEN 5 ELSE 0 END AS f_asset_role,
  CASE WHEN starts_with(source_ip, '192.168.') THEN 1 ELSE 0 END AS f_source_ip_internal,
  CAST(hour(created_at) AS INTEGER) AS f_hour_of_day FROM incidents""",
    "q_tp_gate": ALL + "\nSELECT id AS incident_id, attack_class, confidence, is_tp AS is_true_positive FROM incidents",
    "q_store_row": ALL + f"""
SELECT id, {stamp('created_at')} AS created_at, {stamp('created_at')} AS last_seen, severity, category, confidence,
  source_ips, host AS target_hosts, event_count, status FROM incidents""",
    "q_upsert": _with(RAW, RULES, COUNTED, DISTINCT, FIRED, INCIDENTS, _FOLDED) + f"""
SELECT sid AS id, {stamp('min(created_at)')} AS created_at, {stamp('max(created_at)')} AS updated_at,
  {stamp('min(created_at)')} AS first_seen, {stamp('max(created_at)')} AS last_seen,
  arg_min(severity, (created_at, id)) AS severity, arg_min(category, (created_at, id)) AS category,
  arg_max(confidence, (created_at, id)) AS confidence, arg_min_null(source_ips, (created_at, id)) AS source_ips,
  arg_min(host, (created_at, id)) AS target_hosts, arg_max(event_count, (created_at, id)) AS event_count,
  arg_min(status, (created_at, id)) AS status, CAST(arg_max(event_id, (created_at, id)) AS VARCHAR) AS last_event
FROM repeated GROUP BY sid""",
    "q_edit_persist": _with(RAW, RULES, COUNTED, DISTINCT, FIRED, INCIDENTS, _FOLDED) + f""",
now AS (
  SELECT sid AS id, min(created_at) AS created_at, max(created_at) AS updated_at, arg_min(severity, (created_at, id)) AS severity,
    arg_max(confidence, (created_at, id)) AS confidence, CAST(arg_max(event_id, (created_at, id)) AS VARCHAR) AS last_event
  FROM repeated GROUP BY sid
),
edited AS (SELECT *, severity = 3 AND hour(created_at) < 12 AS first_edit, confidence >= 0.8::DOUBLE AS second_edit FROM now)
SELECT id, {stamp('created_at')} AS created_at,
  CASE WHEN second_edit THEN '2024-03-02 00:00:00.000000' WHEN first_edit THEN '2024-03-01 00:00:00.000000' ELSE {stamp('updated_at')} END AS updated_at,
  severity, confidence, CASE WHEN second_edit THEN 'closed' WHEN first_edit THEN 'investigating' ELSE 'open' END AS status,
  CASE WHEN first_edit THEN 'analyst1' END AS assigned_to, last_event FROM edited""",
    "q_constraints": ALL + """
SELECT id, array_to_string(list_filter([CASE WHEN event_id % 23 = 0 THEN 'first_seen is null' END,
  CASE WHEN event_id % 17 = 0 THEN 'severity out of range' END,
  CASE WHEN event_id % 19 = 0 THEN 'confidence out of range' END,
  CASE WHEN event_id % 5 > 3 THEN 'label out of range' END], lambda x: x IS NOT NULL), '; ') AS reasons
FROM incidents WHERE event_id % 23 = 0 OR event_id % 17 = 0 OR event_id % 19 = 0 OR event_id % 5 > 3""",
    "q_docs": _with(RAW, RULES, COUNTED, DISTINCT, FIRED, INCIDENTS, _FOLDED) + f"""
SELECT sid AS incident_id, {stamp('max(created_at)')} AS ts, arg_max(severity_text, (created_at, id)) AS severity,
  arg_max(status, (created_at, id)) AS status, arg_max(event_count, (created_at, id)) AS event_count,
  arg_max(key, (created_at, id)) AS correlation_key, arg_max(attack_class, (created_at, id)) AS attack_class,
  arg_max(host, (created_at, id)) AS host, 9 AS fields FROM repeated GROUP BY sid""",
    "q_summary": ALL + """
SELECT count(*) AS total, count(*) FILTER (WHERE status = 'open') AS open, count(*) FILTER (WHERE severity = 3) AS critical,
  count(*) FILTER (WHERE severity = 2) AS high, count(*) FILTER (WHERE severity = 1) AS medium,
  count(*) FILTER (WHERE severity = 0) AS info, count(*) FILTER (WHERE is_tp) AS true_positives FROM incidents""",
    "q_health": ALL + "\nSELECT 'ok' AS status, count(*) AS incidents FROM incidents",
    "q_by_severity": ALL + """
SELECT v.name, (SELECT count(*) FROM incidents i WHERE i.severity = v.level) AS value, v.color
FROM (VALUES ('Critique', 3, '#ef4444'), ('Élevé', 2, '#f97316'), ('Moyen', 1, '#eab308'), ('Info', 0, '#3b82f6')) v(name, level, color)""",
    "q_by_category": ALL + "\nSELECT category, count(*) AS cnt FROM incidents GROUP BY category ORDER BY cnt DESC, category LIMIT 8",
    "q_by_status": ALL + "\nSELECT status, count(*) AS cnt FROM incidents GROUP BY status",
    "q_timeline_24h": _timeline("24 HOURS", "hour", "%H:%M"),
    "q_timeline_7d": _timeline("7 DAYS", "day", "%d/%m"),
    "q_timeline_30d": _timeline("30 DAYS", "day", "%d/%m"),
    "q_top_hosts": ALL + """
SELECT host, count(*) AS incident_count, max(severity) AS max_severity FROM incidents GROUP BY host
ORDER BY incident_count DESC, host LIMIT 10""",
    "q_host_share": ALL + """,
top AS (SELECT host, count(*) AS incident_count FROM incidents GROUP BY host ORDER BY incident_count DESC, host LIMIT 10)
SELECT host, incident_count, round(incident_count::DOUBLE / first(incident_count) OVER (ORDER BY incident_count DESC, host) * 100, 6) AS share FROM top""",
    "q_top_rules": ALL + """
SELECT rule_id, rule_name, count(*) AS fired_count, round(avg(confidence), 3) AS avg_confidence FROM incidents
GROUP BY rule_id, rule_name ORDER BY fired_count DESC, rule_id LIMIT 10""",
    "q_conf_hist": ALL + """
SELECT CASE WHEN confidence >= 0.9::DOUBLE THEN '90-100%' WHEN confidence >= 0.7::DOUBLE THEN '70-90%'
  WHEN confidence >= 0.5::DOUBLE THEN '50-70%' ELSE '<50%' END AS "range", count(*) AS "count"
FROM incidents WHERE confidence IS NOT NULL GROUP BY 1""",
    "q_list": ALL + f"""
SELECT {_LIST_COLUMNS} FROM incidents i WHERE i.severity = 3 AND i.status = 'open' AND i.category ILIKE '%movement%'
ORDER BY i.confidence DESC NULLS FIRST, i.id LIMIT 20""",
    "q_list_page2": ALL + f"\nSELECT {_LIST_COLUMNS} FROM incidents i ORDER BY i.created_at DESC NULLS FIRST, i.id LIMIT 20 OFFSET 20",
    "q_page_deep": ALL + f"""
SELECT {_LIST_COLUMNS} FROM incidents i ORDER BY i.created_at DESC NULLS FIRST, i.id LIMIT 20
OFFSET (SELECT (count(*) - 1) // 20 * 20 FROM incidents)""",
    "q_page_meta": ALL + """
SELECT count(*) AS total, 1 AS page, 20 AS per_page, (count(*) + 19) // 20 AS pages FROM incidents
WHERE severity = 3 AND status = 'open' AND category ILIKE '%movement%'""",
    "q_search": ALL + """
SELECT category, count(*) AS n, min(id) AS first_id FROM incidents
WHERE concat_ws(' ', id, rule_name, description, key, host, agent_id, agent_ip, source_ip, srcport, alert_rule,
  alert_text, alert_category, alert_severity, asset_host, role, category) ILIKE '%WEB-srv%' GROUP BY category""",
    "q_search_escape": ALL + r"""
SELECT 'corp\WEB-srv' AS searched, id FROM incidents WHERE starts_with(lower(host), 'web-srv')
UNION ALL SELECT 'CORP\recon', id FROM incidents WHERE starts_with(key, 'recon')""",
    "q_next_page": ALL + f"\nSELECT {_LIST_COLUMNS} FROM incidents i ORDER BY i.confidence DESC NULLS FIRST, i.id LIMIT 20 OFFSET 20",
    "q_recent": ALL + f"""
SELECT id, {stamp('created_at')} AS created_at, severity, category, confidence, status, event_count, host AS target_hosts,
  rule_id, rule_name, attack_class, CAST(is_tp AS VARCHAR) AS is_true_positive, {SEV} AS severity_label, {SEV_FR} AS severity_fr
FROM incidents i ORDER BY i.created_at DESC NULLS FIRST, i.id LIMIT 10""",
    "q_get": ALL + f"""
SELECT id, {stamp('created_at')} AS created_at, severity, {SEV} AS severity_label, {SEV_FR} AS severity_fr, category,
  confidence, status FROM incidents WHERE id = (SELECT min(id) FROM incidents)""",
    "q_update": ALL + f"""
SELECT id, CASE WHEN confidence >= 0.9::DOUBLE THEN 'closed' WHEN confidence >= 0.8::DOUBLE THEN 'investigating' ELSE status END AS status,
  CASE WHEN severity = 3 THEN 'analyst1' END AS assigned_to, CAST(NULL AS VARCHAR) AS analyst_notes,
  CASE WHEN confidence >= 0.8::DOUBLE OR severity = 3 THEN {stamp('(SELECT max(created_at) FROM incidents)')}
    ELSE {stamp('created_at')} END AS updated_at FROM incidents""",
    "q_labels": ALL + f"""
SELECT id, {SEV} AS severity_label, {SEV_FR} AS severity_fr, coalesce({ATTACK_TEXT}, attack_class, category) AS attack_text,
  'Ouvert' AS status_text, format('{{:.1f}}%', confidence * 100) AS confidence_text FROM incidents""",
    "q_top_probs": ALL + """,
probs AS (
  SELECT id, attack_class, confidence AS p FROM incidents
  UNION ALL SELECT id, 'data_exfiltration', round((1.0::DOUBLE - confidence) * 0.75::DOUBLE, 4) FROM incidents
  UNION ALL SELECT id, 'normal_activity', round((1.0::DOUBLE - confidence) * 0.25::DOUBLE, 4) FROM incidents
)
SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY p DESC, attack_class) AS INTEGER) AS rank, attack_class, round(p, 4) AS probability FROM probs""",
    "q_host_overflow": ALL + """,
names AS (
  SELECT id, CASE WHEN asset_host = host THEN [host] ELSE [host, asset_host] END AS a, source_ip, agent_ip FROM incidents
),
more_names AS (SELECT id, CASE WHEN list_contains(a, source_ip) THEN a ELSE list_append(a, source_ip) END AS a, agent_ip FROM names),
every_name AS (SELECT id, CASE WHEN list_contains(a, agent_ip) THEN a ELSE list_append(a, agent_ip) END AS a FROM more_names)
SELECT id, a[1] || ',' || a[2] AS shown, CAST(len(a) - 2 AS INTEGER) AS more FROM every_name""",
    "q_label": LABELS + "\nSELECT * EXCLUDE (event_no) FROM labelled",
    "q_label_csv": LABELS + "\nSELECT * EXCLUDE (event_no) FROM labelled",
    "q_label_dense": _with(RAW, LABELLED.replace("end_s * 1000000 + 5000000", "(end_s + 1728000) * 1000000 + 5000000")) + """
SELECT run_id, count(*) AS n FROM labelled GROUP BY run_id""",
    "q_label_stats": LABELS + """
SELECT count(*) AS matched, (SELECT count(*) FROM events) - count(*) AS skipped FROM labelled""",
    "q_class_dist": LABELS + "\nSELECT label, count(*) AS n FROM labelled GROUP BY label",
    "q_encode": LABELS + """
SELECT event_id, CAST(dense_rank() OVER (ORDER BY rule_id) - 1 AS INTEGER) AS rule_id_enc,
  CAST(dense_rank() OVER (ORDER BY agent_name) - 1 AS INTEGER) AS agent_name_enc,
  CAST(dense_rank() OVER (ORDER BY rule_groups) - 1 AS INTEGER) AS rule_groups_enc,
  CAST(rule_level AS DOUBLE) AS rule_level FROM labelled""",
    "q_group_split": SPLITS + "\nSELECT run_id, split FROM run_splits",
    "q_strat_split": LABELS + """
SELECT event_id, label, CASE WHEN (rk - 1) * 10000 < n * 1500 THEN 'test' WHEN (rk - 1) * 10000 < n * 2996 THEN 'val' ELSE 'train' END AS split
FROM (SELECT event_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(event_id)) AS rk,
  count(*) OVER (PARTITION BY label) AS n FROM labelled)""",
    "q_argmax": _with(RAW) + """
SELECT eid AS event_id, CASE WHEN a >= b AND a >= c THEN 'alert_storm' WHEN b >= c THEN 'benign' ELSE 'brute_force' END AS attack_class,
  greatest(a, b, c) AS confidence, b AS p_benign
FROM (SELECT eid, (event_id % 7) / 16.0::DOUBLE AS a, (event_id % 5) / 16.0::DOUBLE AS b, (event_id % 3) / 16.0::DOUBLE AS c FROM raw)""",
    "q_folds": LABELS + """
SELECT event_id, label, CAST(row_number() OVER (PARTITION BY label ORDER BY md5(event_id)) % 5 AS INTEGER) AS fold FROM labelled""",
    "q_report": PREDICTIONS + """
SELECT label, round("precision", 9) AS "precision", round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM per_class
UNION ALL SELECT 'accuracy', a, a, a, n FROM (SELECT round(sum(hits)::DOUBLE / sum(support), 9) AS a, sum(support)::BIGINT AS n FROM per_class)
UNION ALL SELECT 'macro avg', round(avg("precision"), 9), round(avg(recall), 9), round(avg(f1), 9), sum(support)::BIGINT FROM per_class
UNION ALL SELECT 'weighted avg', round(sum("precision" * support) / sum(support), 9), round(sum(recall * support) / sum(support), 9),
  round(sum(f1 * support) / sum(support), 9), sum(support)::BIGINT FROM per_class""",
    "q_confusion": PREDICTIONS + """
SELECT label, count(*) FILTER (WHERE prediction = 'alert_storm') AS alert_storm, count(*) FILTER (WHERE prediction = 'benign') AS benign,
  count(*) FILTER (WHERE prediction = 'brute_force') AS brute_force, count(*) FILTER (WHERE prediction = 'lateral_movement') AS lateral_movement,
  count(*) FILTER (WHERE prediction = 'privilege_escalation') AS privilege_escalation,
  count(*) FILTER (WHERE prediction = 'reconnaissance') AS reconnaissance FROM predicted GROUP BY label""",
    "q_majority": SPLITS + """,
winner AS (SELECT label FROM predicted JOIN run_splits USING (run_id) WHERE split = 'train' GROUP BY label ORDER BY count(*) DESC, label LIMIT 1),
tested AS (SELECT count(*) AS n, count(*) FILTER (WHERE label = (SELECT label FROM winner)) AS hits FROM predicted JOIN run_splits USING (run_id) WHERE split = 'test')
SELECT (SELECT label FROM winner) AS majority, round(hits::DOUBLE / n, 9) AS accuracy,
  round(2.0::DOUBLE * hits / (hits + n) / (SELECT count(*) FROM classes), 9) AS macro_f1 FROM tested""",
    "q_level_baseline": SPLITS + """
SELECT CAST(label <> 'benign' AS INTEGER) AS actual, CAST(CAST(rule_level AS INTEGER) >= 10 AS INTEGER) AS guess, count(*) AS n
FROM predicted JOIN run_splits USING (run_id) WHERE split = 'test' GROUP BY 1, 2""",
    "q_fpr": PREDICTIONS + """
SELECT benign, wrong, CASE WHEN benign > 0 THEN round(wrong::DOUBLE / benign, 9) END AS fp_rate,
  CASE WHEN benign > 0 THEN 'ok' ELSE 'no benign rows' END AS note
FROM (SELECT count(*) FILTER (WHERE label = 'benign') AS benign,
  count(*) FILTER (WHERE label = 'benign' AND prediction <> 'benign') AS wrong FROM predicted)""",
    "q_calibration": PREDICTIONS + """,
top AS (SELECT label FROM predicted GROUP BY label ORDER BY count(*) DESC, label LIMIT 1)
SELECT CAST(prob > 0.2::DOUBLE AS INTEGER) + CAST(prob > 0.4::DOUBLE AS INTEGER) + CAST(prob > 0.6000000000000001::DOUBLE AS INTEGER)
    + CAST(prob > 0.8::DOUBLE AS INTEGER) AS bin, round(avg(prob), 9) AS mean_predicted,
  round(avg(CAST(label = (SELECT label FROM top) AS INTEGER)), 9) AS observed, count(*) AS n FROM predicted GROUP BY 1""",
    "q_fw_parse": _with(RAW, FIREWALL) + """
SELECT event_id, interface, reason, action, protocol_id, protocol, srcip, dstip, srcport, dstport, '100200' AS rule_id, 3 AS level,
  'pfSense: firewall filter log event (' || action || ' ' || protocol || ' ' || srcip || ':' || srcport || ' -> ' || dstip || ':' || dstport || ')' AS description FROM fw""",
    "q_portscan": _SCAN_SQL,
    "q_portscan_split": _SCAN_SQL,
    "q_ssh_brute": _with(RAW) + f"""
SELECT eid AS event_id, srcip, ts_us, '100210' AS rule_id, 10 AS level,
  'SSH brute force: 6+ failed logins from ' || srcip || ' in {60 * STRETCH}s' AS description, 'T1110' AS mitre,
  'authentication_failures,brute_force' AS groups FROM (
  SELECT eid, srcip, ts_us, count(*) OVER (PARTITION BY srcip ORDER BY ts_us RANGE BETWEEN {60 * STRETCH * 1_000_000} PRECEDING AND CURRENT ROW) AS c
  FROM raw WHERE rule_id = '5710' AND srcip IS NOT NULL) WHERE c >= 6""",
    "q_win_priv": """
SELECT event_id, '100300' AS rule_id, 10 AS level, 'T1078' AS mitre, 'privilege_escalation,windows_security' AS groups
FROM events WHERE event_type IN ('signup', 'click') AND 4670 + event_id % 5 = 4672""",
    "q_rule_class": _with(RAW) + """
SELECT rule_id, CASE WHEN rule_id = '100201' THEN 'reconnaissance' WHEN rule_id IN ('5710','5712','100210') THEN 'brute_force' END AS attack_class,
  count(*) AS n FROM raw GROUP BY rule_id""",
}

# A stream gives what its batch twin gives.
ORACLE["s_ingest"] = ORACLE["q_ingest"]
ORACLE["s_corr"] = ORACLE["q_incidents"]
ORACLE["s_late"] = ORACLE["q_incidents"]
ORACLE["s_store"] = ORACLE["q_store_row"]
