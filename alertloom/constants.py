"""Identifiers, lookup tables and labels that results must reproduce exactly."""

# --- fixed values -----------------------------------------------------------------------

SOURCE_TAG = "wazuh"
CORRELATION_SOURCE_TAG = "correlation-engine"
MODEL_TAG = "spark-rf-v1"

ASSETS = [
    # hostname, ip_address, os, role, site, criticality, owner
    ("wazuh-manager", "192.168.10.10", "Ubuntu 24.04", "siem-server", "haouaria", 3, "SOC"),
    ("web-srv-01", "192.168.10.21", "Ubuntu 22.04", "web-server", "haouaria", 2, "IT"),
    ("db-srv-01", "192.168.10.22", "Ubuntu 22.04", "db-server", "haouaria", 3, "IT"),
    ("win-srv-2022-01", "192.168.10.30", "Windows Server 2022", "file-server", "haouaria", 2, "IT"),
    ("workstation-01", "192.168.20.11", "Windows 10", "workstation", "haouaria", 1, "IT"),
]

BRUTE_FORCE_RULE_IDS = ["60104", "60106", "5710", "5712", "2501", "2502"]
PRIVILEGE_MARKERS = ["privilege", "escalation", "sudo"]
PORT_SCAN_RULE_ID = "100201"

ATTACK_CLASSES = [
    "brute_force",
    "privilege_escalation",
    "lateral_movement",
    "alert_storm",
    "reconnaissance",
    "data_exfiltration",
    "malware_activity",
    "normal_activity",
]

RULE_FEATURE = {
    "CORR-001": 1,
    "CORR-002": 2,
    "CORR-003": 3,
    "CORR-004": 4,
    "CORR-005": 5,
    "CORR-006": 6,
}
SEVERITY_FEATURE = {"info": 0, "low": 1, "medium": 2, "high": 3, "critical": 4}
ROLE_FEATURE = {
    "unknown": 0,
    "workstation": 1,
    "web-server": 2,
    "file-server": 3,
    "db-server": 4,
    "siem-server": 5,
}
FEATURES = [
    "rule_id", "severity", "event_count", "window_sec", "threshold",
    "asset_criticality", "asset_role", "source_ip_internal", "hour_of_day",
]

# Training patterns: class, rule, then half-open integer ranges of severity, event count,
# criticality and role, and the probability of an internal source.
TRAINING_PATTERNS = [
    ("brute_force", 1, (2, 4), (5, 50), (1, 3), (0, 3), 0.3),
    ("brute_force", 1, (3, 4), (5, 30), (1, 2), (1, 2), 0.5),
    ("privilege_escalation", 2, (3, 4), (3, 15), (2, 4), (2, 5), 0.8),
    ("privilege_escalation", 5, (3, 4), (3, 10), (3, 5), (3, 5), 0.9),
    ("lateral_movement", 3, (2, 4), (3, 20), (1, 4), (0, 4), 0.7),
    ("lateral_movement", 5, (3, 4), (3, 12), (2, 4), (1, 4), 0.8),
    ("alert_storm", 4, (1, 3), (20, 100), (1, 3), (0, 3), 0.5),
    ("alert_storm", 4, (2, 3), (20, 80), (1, 2), (0, 2), 0.4),
    ("reconnaissance", 1, (1, 3), (3, 20), (1, 3), (1, 3), 0.2),
    ("reconnaissance", 3, (1, 3), (3, 15), (1, 2), (0, 2), 0.3),
    ("reconnaissance", 6, (3, 4), (1, 3), (1, 4), (0, 4), 0.8),
    ("reconnaissance", 6, (2, 4), (1, 4), (1, 3), (0, 3), 0.6),
    ("data_exfiltration", 3, (2, 4), (3, 10), (3, 5), (3, 5), 0.9),
    ("data_exfiltration", 5, (3, 4), (3, 8), (4, 5), (4, 5), 0.95),
    ("malware_activity", 2, (3, 4), (3, 15), (2, 4), (2, 4), 0.8),
    ("malware_activity", 5, (3, 4), (3, 10), (3, 5), (3, 5), 0.85),
    ("normal_activity", 1, (0, 2), (1, 5), (1, 2), (0, 2), 0.6),
    ("normal_activity", 4, (0, 2), (1, 10), (1, 2), (0, 2), 0.5),
]
TRAINING_WINDOWS = [30, 60, 120, 180, 300]

# Stored severity is 0..3.
SEVERITY_STORED = {"info": 0, "low": 0, "medium": 1, "high": 2, "critical": 3}
SEVERITY_LABEL = {0: "info", 1: "medium", 2: "high", 3: "critical"}
SEVERITY_LABEL_FR = {0: "Info", 1: "Moyen", 2: "Élevé", 3: "Critique"}
SEVERITY_SERIES = [
    # display name, stored severity, colour
    ("Critique", 3, "#ef4444"),
    ("Élevé", 2, "#f97316"),
    ("Moyen", 1, "#eab308"),
    ("Info", 0, "#3b82f6"),
]
ATTACK_LABEL_FR = {
    "brute_force": "Force Brute",
    "privilege_escalation": "Escalade de Privilèges",
    "lateral_movement": "Mouvement Latéral",
    "alert_storm": "Tempête d'Alertes",
    "reconnaissance": "Reconnaissance",
    "data_exfiltration": "Exfiltration de Données",
    "malware_activity": "Activité Malware",
    "normal_activity": "Activité Normale",
}
STATUS_LABEL_FR = {"open": "Ouvert", "closed": "Fermé", "investigating": "En cours"}

# Retention in days by dataset.
RETENTION_DAYS = {
    "alerts_raw": 1,
    "alerts_parsed": 2,
    "alerts_normalized": 7,
    "alerts_enriched": 7,
    "incidents": 30,
    "results": 30,
}

RULE_ATTACK_CLASS = {
    "100201": "reconnaissance",
    "5710": "brute_force",
    "5712": "brute_force",
    "100210": "brute_force",
}

CORRELATION_RULES = [
    # id, name, description, window in seconds, threshold, severity, key prefix
    ("CORR-001", "Brute Force Detection",
     "Multiple authentication failures from the same source IP within a short window", 60, 5, "high", "brute_force"),
    ("CORR-002", "Privilege Escalation Burst",
     "Repeated privilege-related high severity alerts from the same host", 120, 3, "critical", "priv_esc"),
    ("CORR-003", "Lateral Movement",
     "Same source IP triggering alerts on multiple distinct destination hosts", 300, 3, "critical", "lateral"),
    ("CORR-004", "Alert Storm",
     "Abnormally high volume of alerts from a single agent — possible misconfiguration or active attack",
     60, 20, "medium", "alert_storm"),
    ("CORR-005", "Repeated High Severity",
     "Multiple high or critical severity alerts from the same host in a short period", 180, 3, "high", "high_sev"),
    ("CORR-006", "Reconnaissance/ port scan",
     "pfsense port scan confirmed by wazuh frequency correlation (rule 100201)", 30, 1, "high", "recon"),
]

# Detections by rule id: level, MITRE technique, groups, description.
DETECTIONS = {
    "100200": (3, None, ["firewall", "pfsense"], "pfSense: firewall filter log event (%s %s %s:%s -> %s:%s)"),
    "100201": (10, "T1046", ["recon", "port_scan", "pfsense"], "pfSense: Possible port scan - %s hit {count}+ distinct ports in {seconds}s"),
    "100210": (10, "T1110", ["authentication_failures", "brute_force"], "SSH brute force: {count}+ failed logins from %s in {seconds}s"),
    "100300": (10, "T1078", ["privilege_escalation", "windows_security"],
               "Windows: special privileges assigned to new logon (SeDebugPrivilege/SeTakeOwnershipPrivilege) - possible privilege escalation"),
}
