"""Fixed values of the event contract and the reports.

These must equal the source system's vocabulary and the documented report
settings for results to match; everything else in the package refers to them
by name.
"""

# ---- fixed values: event vocabulary -------------------------------------------
PURCHASE_EVENT = "in_app_purchase"
SESSION_EVENT = "session_start"
FIRST_OPEN_EVENT = "first_open"

# ---- fixed values: parameter-bag keys read by staging -----------------------------
ENGAGEMENT_KEY = "engagement_time_msec"
SCREEN_CLASS_KEY = "firebase_screen_class"
PREVIOUS_FIRST_OPEN_KEY = "previous_first_open_count"
SESSION_ID_KEY = "ga_session_id"

# ---- fixed values: source domain ---------------------------------------------------
PLATFORMS = ("ANDROID", "IOS")
NAN_LITERAL = "NaN"

# ---- fixed values: model parameters ------------------------------------------------
MAX_DAY_NUMBER = 30          # D0..D30 window
TRAILING_COHORTS = 28        # trailing baseline: 28 preceding cohort rows
OUTLIER_PERCENTILE = 0.99    # events_total > p99 (strict) is an outlier
ARPPU_TOLERANCE = 0.0001     # abs tolerance of the ARPPU consistency check

# ---- fixed values: dashboard --------------------------------------------------------
DAY_AXIS = (0, 1, 3, 7, 14, 30)
HEADER_RETENTION_DAYS = (1, 3, 7)
HEADLINE_DAY = 7
BASELINE_CALENDAR_DAYS = 28
NOISE_THRESHOLDS = {"arpu": 0.0005, "paying_share": 0.001, "retention": 0.005}
COMPARISON_WEEKS = 5
TOP_N_COUNTRIES = 5
OTHER_LABEL = "Other"
