"""Labels, codes, patterns and weights that results must carry as they are."""

# Weekday names, 1 = Sunday.
DAY_NAMES = {
    1: "Sunday",
    2: "Monday",
    3: "Tuesday",
    4: "Wednesday",
    5: "Thursday",
    6: "Friday",
    7: "Saturday",
}

# Status classes by the first digit of the status code; the analytics queries
# and the BI datasets spell them differently.
STATUS_CLASSES = {
    2: "2xx_Success",
    3: "3xx_Redirect",
    4: "4xx_Client_Error",
    5: "5xx_Server_Error",
}
STATUS_CLASSES_BI = {
    2: "2xx Success",
    3: "3xx Redirect",
    4: "4xx Client Error",
    5: "5xx Server Error",
}
STATUS_CLASS_OTHER = "Unknown"

# Paths that are not page views.
NOISE_PATHS = ["/favicon.ico", "/robots.txt", "/sitemap.xml"]

# A path needs this many requests to be listed.
MIN_PATH_REQUESTS = 10

# Physical bounds of a reading.
TEMP_MAX = 100
TEMP_MIN = -40
HUMIDITY_MAX = 100
HUMIDITY_MIN = 0

# Warning bounds.
TEMP_WARN_HIGH = 85
TEMP_WARN_LOW = -20

# Bounds and steps of the data quality score.
SCORE_TEMP_HIGH = 85
SCORE_TEMP_LOW = -30
SCORE_INVALID = 0.0
SCORE_EXTREME = 0.25
SCORE_DUPLICATE = 0.5
SCORE_GOOD = 1.0

# Reading states.
STATUS_OK = "OK"
STATUS_ANOMALY = "ANOMALY"
STATUS_MISSING = "MISSING"

# Anomaly reasons.
MISSING_READING = "MISSING_READING"
EXTREME_HIGH_TEMP = "EXTREME_HIGH_TEMP"
EXTREME_LOW_TEMP = "EXTREME_LOW_TEMP"
INVALID_HUMIDITY_HIGH = "INVALID_HUMIDITY_HIGH"
INVALID_HUMIDITY_LOW = "INVALID_HUMIDITY_LOW"
HIGH_TEMP_WARNING = "HIGH_TEMP_WARNING"
LOW_TEMP_WARNING = "LOW_TEMP_WARNING"
UNSPECIFIED_ANOMALY = "UNSPECIFIED_ANOMALY"
OTHER_ANOMALY = "ANOMALY"

# Device threshold alerts.
TEMP_TOO_LOW = "TEMP_TOO_LOW"
TEMP_TOO_HIGH = "TEMP_TOO_HIGH"
HUMIDITY_TOO_LOW = "HUMIDITY_TOO_LOW"
HUMIDITY_TOO_HIGH = "HUMIDITY_TOO_HIGH"
WITHIN_THRESHOLD = "WITHIN_THRESHOLD"

# Daily device state.
HIGH_TEMP_BREACH = "HIGH_TEMP_BREACH"
LOW_TEMP_BREACH = "LOW_TEMP_BREACH"
LOW_QUALITY = "LOW_QUALITY"
NORMAL = "NORMAL"
LOW_QUALITY_BELOW = 0.8

# Labels of rolled-up keys.
ALL_DATES = "ALL_DATES"
ALL_DEVICES = "ALL_DEVICES"
ALL_DEVICES_SHORT = "ALL"
ALL_ZONES = "ALL_ZONES"
GRAND_TOTAL = "=== GRAND TOTAL ==="
ZONE_TOTAL = "=== ZONE TOTAL ==="
DEVICE_TOTAL = "=== DEVICE TOTAL ==="

# Trending score: mentions + 0.1 per like + 0.5 per retweet.
LIKE_WEIGHT = 0.1
RETWEET_WEIGHT = 0.5

# Source names of the cross-source summary.
SOURCE_WEB = "web_traffic"
SOURCE_SENSORS = "iot_sensors"
SOURCE_SOCIAL = "social_media"

# Service level targets in percent.
SLA_TARGETS = {"GOLD": 99.9, "SILVER": 99.5, "BRONZE": 99.0}

# The zone the day plan asks for by name.
WATCHED_ZONE = "server_room"

# One access log line: ip, ident, user, [time], "request", status, bytes, "referrer", "agent".
LOG_LINE = (
    r'^([^ ]*)\s+([^ ]*)\s+([^ ]*)\s+\[([^\]]*)\]\s+"([^"]*)"'
    r'\s+([^ ]*)\s+([^ ]*)\s+"([^"]*)"\s+"([^"]*)"$'
)
LOG_TIME = "dd/MMM/yyyy:HH:mm:ss Z"
