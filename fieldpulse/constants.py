"""Fixed values that must equal the reference's for results to match.

Fixed values (stated plainly, in natural order):
  key prefix                      "pvz"
  device-state key                "<prefix>:<env>:<tenant>:device:<device_id>:state"
  low-humidity-streak key         "<prefix>:<env>:<tenant>:device:<device_id>:humidity_low_streak"
  summary key                     "<env>:<tenant>"
  default env / tenant            "prod" / "tenant-1"
  humidity threshold              50.0
  hop window size / slide         600 s / 10 s
  key time to live                600 s
  watermark (readings, dims)      200 ms
  watermark (enriched, summary)   5 s
  drought "bad" level             10 days
  serving look-back ranges        HOUR 24 hours, DAY 30 days, WEEK 26 weeks
  field counts                    humidity/temperature/location 4, state 6
  lenient boolean words           true: 1 true yes on ; false: 0 false no off
  seconds-vs-millis cut-off       10000000000
  topics                          "<env>/<tenant>/sensors/<device>/<kind>"
  kinds                           humidity temperature location state
"""

KEY_PREFIX = "pvz"
DEFAULT_ENV = "prod"
DEFAULT_TENANT = "tenant-1"
HUMIDITY_THRESHOLD = 50.0
WINDOW_SECONDS = 600
SLIDE_SECONDS = 10
KEY_TTL_SECONDS = 600
READING_WATERMARK = "200 milliseconds"
SUMMARY_WATERMARK = "5 seconds"
DROUGHT_DAYS_RED = 10.0
RANGE_BACK = {"HOUR": "24 hours", "DAY": "30 days", "WEEK": "26 weeks"}
FIELD_COUNTS = {"humidity": 4, "temperature": 4, "location": 4, "state": 6}
BOOL_TRUE_WORDS = ("1", "true", "yes", "on")
BOOL_FALSE_WORDS = ("0", "false", "no", "off")
SECONDS_CUTOFF = 10_000_000_000
KINDS = ("humidity", "temperature", "location", "state")
BUCKET_UNITS = {"HOUR": "hour", "DAY": "day", "WEEK": "week"}
