"""These must equal the published data set's own for results to match."""

# City, latitude, longitude, population, area in km2, base air-quality index.
# The position in this (alphabetical) list is the city's code.
CITIES = [
    ("Ahmedabad", 23.02, 72.57, 8_450_000, 505, 120),
    ("Bangalore", 12.97, 77.59, 13_190_000, 741, 85),
    ("Bhopal", 23.26, 77.41, 2_400_000, 463, 90),
    ("Chennai", 13.08, 80.27, 9_110_000, 426, 80),
    ("Coimbatore", 11.00, 76.96, 2_150_000, 246, 70),
    ("Delhi", 28.61, 77.20, 32_940_000, 1484, 180),
    ("Hyderabad", 17.38, 78.47, 10_350_000, 650, 95),
    ("Indore", 22.72, 75.86, 3_500_000, 530, 100),
    ("Jaipur", 26.91, 75.79, 3_950_000, 467, 115),
    ("Kochi", 9.93, 76.26, 2_120_000, 94, 65),
    ("Kolkata", 22.57, 88.36, 14_850_000, 185, 130),
    ("Lucknow", 26.85, 80.95, 3_680_000, 349, 160),
    ("Mumbai", 19.07, 72.87, 20_670_000, 603, 110),
    ("Nagpur", 21.14, 79.08, 2_900_000, 227, 95),
    ("Patna", 25.59, 85.13, 2_350_000, 136, 155),
    ("Pune", 18.52, 73.85, 7_280_000, 331, 90),
    ("Surat", 21.17, 72.83, 7_180_000, 395, 105),
    ("Visakhapatnam", 17.69, 83.22, 2_100_000, 682, 75),
]

# Record used for a city that is not listed.
DEFAULT_POPULATION = 5_000_000
DEFAULT_AREA_KM2 = 400

# Weight of a sector and modifier of a zone in the waste formula.
# Codes are alphabetical positions.
SECTOR_WEIGHTS = {"Residential": 120, "Commercial": 200, "Industrial": 350, "Healthcare": 80}
ZONE_MODIFIERS = {"North": 1.0, "South": 0.95, "East": 1.05, "West": 0.98, "Central": 1.10}

# WMO weather codes.
WMO_LABELS = {
    0: "Clear", 1: "Clear", 2: "Partly Cloudy", 3: "Clouds",
    45: "Fog", 48: "Fog",
    51: "Drizzle", 53: "Drizzle", 55: "Drizzle",
    61: "Rain", 63: "Rain", 65: "Heavy Rain",
    71: "Snow", 73: "Snow", 75: "Heavy Snow",
    80: "Rain", 81: "Rain", 82: "Heavy Rain",
    95: "Thunderstorm", 96: "Thunderstorm", 99: "Thunderstorm",
}
WMO_DEFAULT = "Clear"

# Season label and code by month.
SEASON_MONTHS = {
    "Post-Monsoon": (10, 11),
    "Rainy": (6, 7, 8, 9),
    "Summer": (3, 4, 5),
    "Winter": (12, 1, 2),
}
SEASON_CODES = {"Post-Monsoon": 0, "Rainy": 1, "Summer": 2, "Winter": 3}

# Model features in training order, and the target.
FEATURES = [
    "temperature", "humidity", "population", "pollution_index",
    "population_density", "year", "month", "day_of_week", "is_weekend",
    "sector_enc", "weather_condition_enc", "location_enc",
    "season_enc", "zone_enc",
]
TARGET = "waste_amount"

# Column lists of the raw and the cleaned table.
RAW_COLUMNS = [
    "location", "date", "temperature", "humidity", "weather_condition", "population",
    "zone", "sector", "pollution_index", "waste_amount",
]
CLEAN_COLUMNS = [
    "location", "date", "temperature", "humidity", "weather_condition", "population",
    "area_km2", "population_density", "zone", "zone_enc", "sector", "sector_enc",
    "pollution_index", "year", "month", "day", "day_of_week", "is_weekend",
    "season", "season_enc", "weather_condition_enc", "location_enc", "waste_amount",
]
DOUBLE_COLUMNS = ["temperature", "pollution_index", "population_density", "area_km2", "waste_amount"]
INT_COLUMNS = [
    "humidity", "population", "zone_enc", "sector_enc", "year", "month", "day",
    "day_of_week", "is_weekend", "season_enc", "weather_condition_enc", "location_enc",
]
# Column order of the ML-ready table: the features, then the target.
ML_COLUMNS = [*FEATURES, TARGET]
# Narrow types of the cleaning step.
NARROW_TYPES = {
    "temperature": "float", "humidity": "smallint", "pollution_index": "float",
    "waste_amount": "float", "population": "bigint", "year": "smallint", "month": "tinyint",
    "day": "tinyint", "day_of_week": "tinyint", "is_weekend": "tinyint",
}
FORECAST_COLUMNS = [
    "date", "temperature", "humidity", "pollution_index", "population_density",
    "season_enc", "predicted_waste",
]

# The columns of the two correlation heat maps and of the histograms.
HIST_COLUMNS = ["temperature", "humidity", "pollution_index", "population_density", "waste_amount"]
EDA_CORR_COLUMNS = [
    "temperature", "humidity", "pollution_index", "population_density", "sector_enc", "zone_enc",
    "location_enc", "weather_condition_enc", "season_enc", "year", "month", "day_of_week",
    "is_weekend", "waste_amount",
]
VIZ_CORR_COLUMNS = [
    "temperature", "humidity", "population", "pollution_index", "population_density", "month",
    "day_of_week", "is_weekend", "sector_enc", "season_enc", "zone_enc",
    "weather_condition_enc", "location_enc", "waste_amount",
]
SECTOR_BOX_ORDER = ["Industrial", "Commercial", "Residential", "Healthcare"]

# Constants of the forecast, of cleaning and of the alerts.
FORECAST_TEMPERATURE = 30.0
FORECAST_HUMIDITY = 60
FORECAST_AQI = 100.0
FORECAST_BOUNDS = (50.0, 1200.0)
WASTE_BOUNDS = (50.0, 1000.0)
WASTE_PER_PERSON = 0.00005
WASTE_PER_DEGREE = 0.5  # middle of 0.3 to 0.7
WASTE_PER_HUMIDITY = 0.1  # middle of 0.05 to 0.15
AQI_BOUNDS = (20.0, 500.0)
WASTE_CAP = 1000.0
CAP_REPAIR_MEAN, CAP_REPAIR_STD = 1050.0, 80.0
CAP_REPAIR_BOUNDS = (800.0, 1200.0)
ALERT_HIGH, ALERT_MODERATE = 800.0, 650.0
MIN_ROWS = 50_000
SEED = 42
