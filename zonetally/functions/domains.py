"""Fixed values shared by the operators."""

# Zones: id, name, lat_min, lat_max, lon_min, lon_max (degrees).
ZONES = [
    ("Z1", "Providencia", -33.445, -33.420, -70.640, -70.600),
    ("Z2", "Las Condes", -33.420, -33.390, -70.600, -70.550),
    ("Z3", "Maipu", -33.530, -33.490, -70.790, -70.740),
    ("Z4", "Santiago Centro", -33.460, -33.430, -70.670, -70.630),
    ("Z5", "Pudahuel", -33.470, -33.430, -70.810, -70.760),
]
ZONE_IDS = ["Z1", "Z2", "Z3", "Z4", "Z5"]
KM_PER_DEGREE = 111.32

# Request domains.
QUERY_TYPES = ["Q1", "Q2", "Q3", "Q4", "Q5"]
CONFIDENCE_LEVELS = [i * 5 / 100 for i in range(21)]
BIN_LEVELS = [3, 4, 5, 6, 8, 10, 12, 15, 20]
DEFAULT_BINS = 5

# Popularity order of zones and query types, most requested first.
ZONE_POPULARITY = ["Z1", "Z4", "Z2", "Z3", "Z5"]
QUERY_POPULARITY = ["Q1", "Q3", "Q2", "Q5", "Q4"]

# Seconds a stored answer stays valid.
TTL_SECONDS = {"Q1": 300, "Q2": 300, "Q3": 180, "Q4": 120, "Q5": 600}
DEFAULT_TTL_SECONDS = 300

# An attempt with this number is the last one before the dead letter topic.
MAX_RETRIES = 3

# Report grid and scenarios, in display order.
POLICIES = ["LRU", "LFU", "FIFO"]
SIZES = ["50mb", "200mb", "500mb"]
DISTRIBUTIONS = ["zipf", "uniform"]
SCENARIOS = ["base_sync", "kafka_1c", "kafka_3c", "failure", "spike"]
TARGET_QPS = 60.0
