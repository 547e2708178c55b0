"""Fixed values that must equal the source system's for identical results.

Everything in this module is a literal table of domain values (fault
catalogue, severity ladders, risk weights, thresholds, action strings).
They are stated plainly, in natural order, and are consumed as small
broadcast dimension tables or ``when`` chains.
"""
from __future__ import annotations

# --------------------------------------------------------------------------
# FIXED VALUES: telemetry schema
# --------------------------------------------------------------------------
XMEAS_COLUMNS = [f"xmeas_{i}" for i in range(1, 42)]
XMV_COLUMNS = [f"xmv_{i}" for i in range(1, 12)]
SENSOR_COLUMNS = XMEAS_COLUMNS + XMV_COLUMNS

ROLLING_WINDOWS = [10, 20, 30, 50, 100]
SAMPLE_MINUTES = 3
BINARY_THRESHOLD = 0.35

# --------------------------------------------------------------------------
# FIXED VALUES: backend fault catalogue (id, name, description, type, severity, action)
# --------------------------------------------------------------------------
FAULT_CATALOG = [
    (0, "Normal Operation", "All process variables within steady-state envelope.", "Normal", "NONE",
     "Continue routine monitoring."),
    (1, "A/C Feed Ratio Step Change", "Stream 4 A/C feed ratio steps (B held constant).", "Step", "MEDIUM",
     "Verify feed-ratio controller setpoint and flow meters on stream 4."),
    (2, "B Composition Step Change", "B composition in stream 4 steps (A/C ratio constant).", "Step", "MEDIUM",
     "Inspect feed gas chromatograph and stream 4 composition analyser."),
    (3, "D Feed Temperature Step", "Step disturbance on stream 2 (D feed) inlet temperature.", "Step", "LOW",
     "Check D-feed pre-heater and upstream heat exchanger fouling."),
    (4, "Reactor Cooling Inlet Temperature Step", "Reactor cooling water inlet temperature step disturbance.",
     "Step", "HIGH", "Inspect reactor cooling water supply, heat-exchanger fouling, cooling tower."),
    (5, "Condenser Cooling Inlet Temperature Step", "Condenser cooling water inlet temperature step disturbance.",
     "Step", "MEDIUM", "Inspect condenser cooling-water supply temperature and flow."),
    (6, "A Feed Loss", "Stream 1 (A feed) loss - severe loss of reactant.", "Step", "CRITICAL",
     "EMERGENCY: verify stream 1 valves, isolate, switch to backup feed line."),
    (7, "C Header Pressure Loss", "Stream 4 C header pressure loss - reduced availability.", "Step", "HIGH",
     "Inspect stream 4 header pressure regulator and supply compressor."),
    (8, "A/B/C Feed Composition Random Variation", "Random variation in feed composition of A, B and C in stream 4.",
     "Random", "MEDIUM", "Recalibrate composition analyser and review supplier feed quality logs."),
    (9, "D Feed Temperature Random Variation", "Random variation in stream 2 D-feed temperature.", "Random", "LOW",
     "Inspect D-feed temperature sensor and pre-heater control loop."),
    (10, "C Feed Temperature Random Variation", "Random variation in stream 4 C-feed temperature.", "Random", "LOW",
     "Inspect stream 4 inlet temperature sensor and pre-heater."),
    (11, "Reactor Cooling Inlet Temperature Random", "Random variation in reactor cooling water inlet temperature.",
     "Random", "HIGH", "Inspect cooling water supply line, pumps and tower performance."),
    (12, "Condenser Cooling Inlet Temperature Random", "Random variation in condenser cooling water inlet temperature.",
     "Random", "MEDIUM", "Inspect condenser cooling water supply and pump performance."),
    (13, "Reaction Kinetics Slow Drift", "Slow drift in reaction kinetics - possible catalyst degradation.", "Drift",
     "HIGH", "Schedule catalyst sampling and assay; plan catalyst replacement window."),
    (14, "Reactor Cooling Valve Sticking", "Reactor cooling water valve sticking - actuator fault.", "Sticking",
     "CRITICAL", "EMERGENCY: dispatch maintenance to reactor cooling valve actuator."),
    (15, "Condenser Cooling Valve Sticking", "Condenser cooling water valve sticking - actuator fault.", "Sticking",
     "HIGH", "Dispatch maintenance to condenser cooling valve actuator."),
    (16, "Unknown Disturbance #16", "Undocumented fault pattern - investigate process state.", "Unknown", "MEDIUM",
     "Trigger forensic data review; involve process engineer."),
    (17, "Unknown Disturbance #17", "Undocumented fault pattern - investigate process state.", "Unknown", "MEDIUM",
     "Trigger forensic data review; involve process engineer."),
    (18, "Unknown Disturbance #18", "Undocumented fault pattern - investigate process state.", "Unknown", "MEDIUM",
     "Trigger forensic data review; involve process engineer."),
    (19, "Unknown Disturbance #19", "Undocumented fault pattern - investigate process state.", "Unknown", "MEDIUM",
     "Trigger forensic data review; involve process engineer."),
    (20, "Unknown Disturbance #20", "Undocumented fault pattern - investigate process state.", "Unknown", "MEDIUM",
     "Trigger forensic data review; involve process engineer."),
]

# defaults for an id missing from the catalogue
UNKNOWN_FAULT_SEVERITY = "MEDIUM"
UNKNOWN_FAULT_TYPE = "Unknown"
UNKNOWN_FAULT_ACTION = "Investigate anomaly with process engineer."
UNKNOWN_FAULT_ALERT_ACTION = "Investigate."
UNKNOWN_FAULT_DESCRIPTION = "Unrecognised fault pattern."
UNKNOWN_FAULT_STATUS = "WARNING"
UNKNOWN_SEVERITY_WEIGHT = 0.60

# --------------------------------------------------------------------------
# FIXED VALUES: severity ladders and risk fusion
# --------------------------------------------------------------------------
SEVERITY_TO_STATUS = {"NONE": "NORMAL", "LOW": "ADVISORY", "MEDIUM": "WARNING", "HIGH": "ALERT",
                      "CRITICAL": "EMERGENCY"}
SEVERITY_RANK = {"NONE": 0, "LOW": 1, "MEDIUM": 2, "HIGH": 3, "CRITICAL": 4}
RISK_SEVERITY_WEIGHT = {"NONE": 0.00, "LOW": 0.35, "MEDIUM": 0.60, "HIGH": 0.85, "CRITICAL": 1.00}
# inclusive lower bounds; LOW is listed but never used by the level function
RISK_LEVEL_THRESHOLDS = {"LOW": 0.25, "MEDIUM": 0.50, "HIGH": 0.75}

# --------------------------------------------------------------------------
# FIXED VALUES: operator-facing replay rules
# --------------------------------------------------------------------------
# per-class operational risk; class 13 is HIGH only above p 0.8; 16-20 LOW; others LOW
OPERATIONAL_RISK = {1: "MEDIUM", 2: "MEDIUM", 3: "LOW", 4: "HIGH", 5: "HIGH", 6: "HIGH", 7: "HIGH",
                    8: "MEDIUM", 9: "LOW", 10: "LOW", 11: "HIGH", 12: "MEDIUM", 14: "HIGH", 15: "HIGH"}
CLASS13_HIGH_ABOVE = 0.8
CRITICAL_P = 0.92

RECOMMENDED_ACTIONS = {
    1: "Check A/C feed ratio — verify stream 4 composition analysis",
    2: "Check B composition in stream 4 — request lab sample",
    3: "Monitor D feed temperature — check stream 2 heat exchanger",
    4: "CHECK REACTOR COOLING WATER — inspect CW inlet temperature and flow",
    5: "Check condenser cooling water — inspect CV-31 valve position",
    6: "EMERGENCY: A feed loss detected — check stream 1 valve and upstream supply",
    7: "Check C header pressure — inspect stream 4 supply pressure",
    8: "Monitor feed composition — request stream 4 analysis",
    9: "Monitor D feed temperature — within normal variation",
    10: "Monitor C feed temperature — within normal variation",
    11: "Check reactor cooling water temperature — inspect CW system",
    12: "Monitor condenser cooling water temperature",
    13: "Monitor reaction kinetics — check catalyst activity. Schedule inspection.",
    14: "INSPECT REACTOR CW VALVE — stiction detected. Manual check required.",
    15: "INSPECT CONDENSER CW VALVE — stiction detected. Manual check required.",
}
ACTION_UNCLASSIFIED = "Review process data and contact process engineer for unclassified signature."
ACTION_FALLBACK = "Review process data and contact process engineer."
ACTION_NORMAL = "Maintain steady-state operation"

# --------------------------------------------------------------------------
# FIXED VALUES: alarm management tuning (code values; prose values differ)
# --------------------------------------------------------------------------
# tuning for the events-derived telemetry view (value has mean ~50, sd ~49)
ALARM_TUNING_EVENTS = dict(alpha=0.2, sigma=1.0, pad=2.0, n_on=2, n_off=3, lockout=4, max_latch=6,
                           roc_mult=3.0, hysteresis=1.0, tail=0.35)
BASELINE_EPS = 1e-12

# --------------------------------------------------------------------------
# FIXED VALUES: threshold tuning
# --------------------------------------------------------------------------
SWEEP_GRID_PERCENT = list(range(10, 95, 2))   # 0.10 .. 0.94 step 0.02, 43 points
MISSED_FAULT_TARGET = 0.10
MAX_FAR_ALLOWED = 0.50
OUTLIER_Z = 6.0

# leakage guard: feature names containing any of these words are rejected
# (union of the two lists used by the binary and multiclass notebooks)
LEAKAGE_WORDS_BINARY = ["fault", "label", "binary", "source", "run", "sample", "time", "target", "idv",
                        "severity", "risk", "alarm", "health", "prediction", "probability"]
LEAKAGE_WORDS_MULTICLASS = ["fault", "label", "target", "source", "run", "sample", "time", "prediction",
                            "probability", "alarm", "health", "severity"]

# nominal sensor bands (separator pressure XMEAS_13, condenser CW flow XMV_11, CW outlet temp XMEAS_22)
NORMAL_RANGES = [("xmeas_13", 2540.0, 2700.0), ("xmv_11", 12.0, 26.0), ("xmeas_22", 75.0, 81.0)]

# --------------------------------------------------------------------------
# FIXED VALUES: incident and maintenance ladders
# --------------------------------------------------------------------------
URGENCY_BY_SEVERITY = {"CRITICAL": "P1", "HIGH": "P2", "MEDIUM": "P3", "LOW": "P4"}
NOTIFICATION_CAP = 99
RECALL_WATCH_BELOW = 0.88
RECALL_WATCH_HIGH_BELOW = 0.75
RECALL_WATCH_MAX = 12

# --------------------------------------------------------------------------
# FIXED VALUES: item ids of the default operator checklist (the repeated id is
# intentional: checking one of the two checks both)
# --------------------------------------------------------------------------
DEFAULT_CHECKLIST_IDS = ["review", "notes", "dcs", "dcs"]

# --------------------------------------------------------------------------
# FIXED VALUES: texts of generated records
# --------------------------------------------------------------------------
TEXT_DETECTED = ("⚠ Fault IDV(", ") detected — ")
TEXT_CONFIRM_READINGS = ("Digital twin tick ", ": confirm field readings")
TEXT_FINDING = " — model-driven finding"
TEXT_LIVE_TITLE = " — simulation active"
TEXT_LIVE_DIAGNOSIS = ("AI twin: elevated residual on ", " · severity stage ")
TEXT_RECALL_WATCH = "Holdout recall watch · TEP fault class "
STRATEGY_BOTH = "recall>90% AND FAR<50%"
STRATEGY_RECALL = "recall>90% only"
STRATEGY_BEST = "best recall available"

# --------------------------------------------------------------------------
# FIXED VALUES: operator-facing fault catalogue
# (id, label, description, fault type, affected systems, recommended action, action detail, base failure minutes)
# --------------------------------------------------------------------------
OPERATOR_CATALOG = [
    (0, "Normal behavior", "Normal behavior", "None", ["Plant-wide"], "Maintain steady-state operation",
     "Continue monitoring key loops and historian QA. No injected benchmark fault.", 120),
    (1, "Fault 1 — A/C feed ratio", "A/C feed ratio, B composition constant", "Step",
     ["Feed header", "A/C blending", "FIC loops"], "Verify feed ratio cascade",
     "Check A and C flow controllers against lab B analysis · confirm ratio SP integrity.", 14),
    (2, "Fault 2 — B composition", "B composition, A/C ratio constant", "Step", ["B stream", "Composition analyzer"],
     "Confirm B quality", "Grab sample on B · verify analyzer calibration · review stripper side reactions.", 16),
    (3, "Fault 3 — D feed temperature", "D feed temperature", "Step", ["D feed", "Pre-heat exchanger"],
     "Stabilize D feed enthalpy", "Inspect D feed preheat · verify steam trap on trim heater · watch reactor inlet T.",
     12),
    (4, "Fault 4 — Reactor CW inlet T", "Reactor cooling water inlet temperature", "Step",
     ["R-101 jacket", "CW supply", "TIC-101"], "Restore reactor cooling margin",
     "Verify CW header temperature · inspect isolation valves · stage mechanical on jacket circuit.", 10),
    (5, "Fault 5 — Condenser CW inlet T", "Condenser cooling water inlet temperature", "Step",
     ["Overhead condenser", "CW return"], "Recover condensing duty",
     "Check CW flow to condenser · confirm ΔT across bundle · review tower pressure.", 11),
    (6, "Fault 6 — A feed loss", "A feed loss", "Step", ["A feed pump", "FIC-204", "Inventory"],
     "Stabilize A inventory",
     "Confirm pump run status · check block valves · balance feeds to maintain mass balance.", 18),
    (7, "Fault 7 — C header pressure loss", "C header pressure loss", "Step", ["C header", "PIC", "Compressor suction"],
     "Investigate pressure loss",
     "Walk down C header for leaks/restrictions · verify compressor inlet pressure control.", 9),
    (8, "Fault 8 — A,B,C composition", "A, B, C feed composition", "Random Variation", ["Feed analyzers", "Blending"],
     "Tighten analyzer QA",
     "Compare redundant analyzers · increase lab frequency · alert planning to quality risk.", 40),
    (9, "Fault 9 — D feed temperature", "D feed temperature", "Random Variation", ["D feed", "Trim heat"],
     "Dampen D feed thermal noise",
     "Review TC tuning on D preheat · check steam supply swings · consider feed-forward bias.", 22),
    (10, "Fault 10 — C feed temperature", "C feed temperature", "Random Variation", ["C feed", "Heat integration"],
     "Stabilize C feed thermal profile",
     "Inspect C feed exchanger pass · verify control valve travel · monitor reactor delta-T.", 22),
    (11, "Fault 11 — Reactor CW inlet T", "Reactor cooling water inlet temperature", "Random Variation",
     ["CW header", "R-101 jacket"], "Track CW variability",
     "Correlate CW upset with ambient/utility swings · prep reactor MV limits if needed.", 25),
    (12, "Fault 12 — Condenser CW inlet T", "Condenser cooling water inlet temperature", "Random Variation",
     ["Condenser CW", "Tower pressure"], "Mitigate CW noise to tower",
     "Review condenser CW valve tuning · watch tower pressure CV · coordinate with utilities.", 24),
    (13, "Fault 13 — Reaction kinetics", "Reaction kinetics", "Slow Drift", ["R-101", "Catalyst system"],
     "Monitor conversion drift",
     "Track heat generation vs. feed · schedule catalyst assessment · compare model residuals.", 55),
    (14, "Fault 14 — Reactor CW valve", "Reactor cooling water valve", "Sticking", ["Reactor CW valve", "TIC cascade"],
     "Address valve stiction",
     "Bump-test CW valve · check I/P · plan isolation for bench test or trim replacement.", 15),
    (15, "Fault 15 — Condenser CW valve", "Condenser cooling water valve", "Sticking",
     ["Condenser CW valve", "Tower pressure"], "Service condenser CW valve",
     "Hand-jog valve if safe · verify position feedback · prepare maintenance window.", 15),
    (16, "Fault 16 — Unknown", "Unknown", "Unknown", ["Plant-wide"], "Broaden diagnostics",
     "Run multivariate fingerprinting · escalate to engineering · hold major setpoint moves.", 30),
    (17, "Fault 17 — Unknown", "Unknown", "Unknown", ["Plant-wide"], "Broaden diagnostics",
     "Cross-check historian vs. lab · review recent maintenance · widen AI monitoring bands.", 30),
    (18, "Fault 18 — Unknown", "Unknown", "Unknown", ["Plant-wide"], "Broaden diagnostics",
     "Correlate auxiliary utilities · verify field bus health · preserve event log chain.", 30),
    (19, "Fault 19 — Unknown", "Unknown", "Unknown", ["Plant-wide"], "Broaden diagnostics",
     "Engage shift supervisor · prep safe parking procedure if uncertainty persists.", 30),
    (20, "Fault 20 — Unknown", "Unknown", "Unknown", ["Plant-wide"], "Broaden diagnostics",
     "Treat as reserved benchmark class · follow site abnormal event protocol.", 30),
]
ACTION_DETAIL_FAULT = "Contact process engineer if deviation persists."
ACTION_DETAIL_NORMAL = "Continue monitoring reactor exotherm and separator delta-P. No model alarm on this timestep."
SNAPSHOT_SENSOR_DEFAULTS = {"reactor_temp": 120, "flow_rate": 41, "separator_pressure": 77, "vibration": 18}
SNAPSHOT_FALLBACK_SYSTEMS = ["R-101", "Catalyst system"]
CLASS13_DESCRIPTION = "Reaction Kinetics Slow Drift"
MAINTENANCE_IMPACT_CRITICAL = "Immediate production / safety exposure"
MAINTENANCE_IMPACT_OTHER = "Elevated downtime probability within predicted window"

# --------------------------------------------------------------------------
# FIXED VALUES: operator-facing sensor names (tags missing here fall back to
# "Plant sensor <n>" for xmeas tags, else the tag itself)
# --------------------------------------------------------------------------
SENSOR_PLAIN_NAMES = {
    "xmeas_1": "A feed flow", "xmeas_2": "D feed flow", "xmeas_3": "E feed flow", "xmeas_4": "A and C feed flow",
    "xmeas_5": "Recycle flow", "xmeas_6": "Reactor feed rate", "xmeas_7": "Reactor pressure",
    "xmeas_8": "Reactor level", "xmeas_9": "Reactor temperature", "xmeas_10": "Purge rate",
    "xmeas_11": "Separator temperature", "xmeas_12": "Product separator level", "xmeas_13": "Separator pressure",
    "xmeas_14": "Product separator level", "xmeas_15": "Stripper level", "xmeas_16": "Stripper pressure",
    "xmeas_17": "Recycle flow rate", "xmeas_18": "Stripper steam flow", "xmeas_19": "Compressor work",
    "xmeas_20": "Reactor cooling water outlet temperature", "xmeas_21": "Separator cooling water outlet temperature",
    "xmeas_22": "Component A in purge", "xmeas_23": "Component B in purge", "xmeas_24": "Component C in purge",
    "xmeas_25": "Component D in purge", "xmeas_26": "Component E in purge", "xmeas_27": "Component F in purge",
    "xmeas_28": "Component G in purge", "xmeas_31": "Component A in product", "xmeas_32": "Component B in product",
    "xmeas_33": "Component C in product", "xmeas_34": "Component D in product", "xmeas_35": "Component E in product",
    "xmeas_36": "Component F in product", "xmeas_37": "Component G in product", "xmeas_38": "Component H in product",
    "xmeas_39": "Component A in bottoms", "xmeas_40": "Component B in bottoms", "xmeas_41": "Component C in bottoms",
    "xmv_1": "D feed flow valve", "xmv_2": "E feed flow valve", "xmv_3": "A feed flow valve",
    "xmv_4": "A and C feed flow valve", "xmv_5": "Compressor recycle valve", "xmv_6": "Purge valve",
    "xmv_7": "Separator pot liquid flow valve", "xmv_8": "Stripper liquid product flow valve",
    "xmv_9": "Stripper steam valve", "xmv_10": "Reactor cooling water flow valve",
    "xmv_11": "Condenser cooling water flow valve",
}
