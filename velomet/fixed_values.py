"""Names, edges, formats and constants that results depend on.

Everything here is a stated fact of the data model (column spellings, unit factors, band
edges, reference levels). Nothing in this module computes.
"""

# ---------------------------------------------------------------- raw trip files
# Spellings found in trip file headers, after lower-casing, and their canonical name.
COLUMN_RENAMES = {
    "tripduration": "trip_duration",
    "starttime": "start_time",
    "stoptime": "stop_time",
    "bikeid": "bike_id",
    "usertype": "user_type",
    "started_at": "start_time",
    "ended_at": "stop_time",
    "start_lat": "start_station_latitude",
    "start_lng": "start_station_longitude",
    "end_lat": "end_station_latitude",
    "end_lng": "end_station_longitude",
}

# Columns that only one of the two layouts has.
CURRENT_SIGNALS = {"ride_id", "rideable_type", "member_casual"}
LEGACY_SIGNALS = {"trip_duration", "bike_id", "user_type", "birth_year"}

STATION_COLUMNS = [
    ("start_station_id", "string"),
    ("start_station_name", "string"),
    ("start_station_latitude", "double"),
    ("start_station_longitude", "double"),
    ("end_station_id", "string"),
    ("end_station_name", "string"),
    ("end_station_latitude", "double"),
    ("end_station_longitude", "double"),
]

LEGACY_COLUMNS = [
    ("trip_duration", "bigint"),
    ("start_time", "timestamp_ntz"),
    ("stop_time", "timestamp_ntz"),
    *STATION_COLUMNS,
    ("bike_id", "string"),
    ("user_type", "string"),
    ("birth_year", "double"),
    ("gender", "bigint"),
]

CURRENT_COLUMNS = [
    ("ride_id", "string"),
    ("rideable_type", "string"),
    ("start_time", "timestamp_ntz"),
    ("stop_time", "timestamp_ntz"),
    *STATION_COLUMNS,
    ("member_casual", "string"),
]

ERA_COLUMNS = {"legacy": LEGACY_COLUMNS, "current": CURRENT_COLUMNS}

UNIFIED_COLUMNS = [
    ("ride_id", "string"),
    ("rideable_type", "string"),
    ("start_time", "timestamp_ntz"),
    ("stop_time", "timestamp_ntz"),
    ("trip_duration_seconds", "bigint"),
    *STATION_COLUMNS,
    ("member_casual", "string"),
    ("bike_id", "string"),
    ("birth_year", "bigint"),
    ("gender", "bigint"),
    ("distance_meters", "double"),
    ("region", "string"),
    ("source_era", "string"),
    ("source_file", "string"),
]

NULL_MARKERS = ["NULL", "\\N"]
RIDER_OF_USER_TYPE = {"Subscriber": "member", "Customer": "casual"}

# First day owned by the current layout; older current-layout rows repeat legacy ones.
CURRENT_ERA_START = "2021-02-01"

# ---------------------------------------------------------------- hourly observations
# (raw column, typed column, whether the trace marker T reads as 0.0)
OBSERVATION_NUMBERS = [
    ("HourlyDryBulbTemperature", "temp_c", False),
    ("HourlyDewPointTemperature", "dewpoint_c", False),
    ("HourlyWetBulbTemperature", "wetbulb_c", False),
    ("HourlyRelativeHumidity", "rh_pct", False),
    ("HourlyPrecipitation", "precip_mm", True),
    ("HourlySeaLevelPressure", "slp_hpa", False),
    ("HourlyStationPressure", "station_pressure_hpa", False),
    ("HourlyAltimeterSetting", "altimeter_hpa", False),
    ("HourlyWindSpeed", "wind_speed_ms", False),
    ("HourlyWindGustSpeed", "wind_gust_ms", False),
    ("HourlyWindDirection", "wind_dir_deg", False),
    ("HourlyVisibility", "visibility_km", False),
]
OBSERVATION_TEXTS = [
    ("HourlySkyConditions", "sky_conditions"),
    ("HourlyPresentWeatherType", "present_weather"),
]
ROUTINE_REPORT = "FM-15"
KEPT_REPORTS = ["FM-15", "FM-16"]

# Cells that the CSV reader of the weather files treats as missing.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Present-weather code groups behind the falling-now flags.
PRESENT_WEATHER_CODES = {
    "is_raining": "RA|DZ",
    "is_snowing": "SN|SG|PL|GS",
    "is_foggy": "FG",
    "is_thunder": "TS",
    "is_hazy": "HZ",
}

STANDARD_TIME_ZONE = "Etc/GMT+5"
LOCAL_TIME_ZONE = "America/New_York"
HOME_STATION = "USW00094728"

# ---------------------------------------------------------------- daily observations
# (typed column, element code, divisor)
DAILY_ELEMENTS = [
    ("tmin_c", "TMIN", 10.0),
    ("tmax_c", "TMAX", 10.0),
    ("prcp_mm", "PRCP", 10.0),
    ("snow_mm", "SNOW", 1.0),
    ("snow_depth_mm", "SNWD", 1.0),
    ("rh_avg", "RHAV", 1.0),
    ("rh_min", "RHMN", 1.0),
    ("rh_max", "RHMX", 1.0),
    ("dewpoint_c", "ADPT", 10.0),
    ("wetbulb_c", "AWBT", 10.0),
    ("slp_hpa", "ASLP", 10.0),
    ("stp_hpa", "ASTP", 10.0),
    ("wind_avg_ms", "AWND", 10.0),
    ("wind_gust_ms", "WSF2", 10.0),
    ("wind_dir_deg", "WDF2", 1.0),
]
DAILY_MEAN_ELEMENT = "TAVG"
DAILY_FLAGS = [("is_foggy", "WT01"), ("is_thunder", "WT03"), ("is_hazy", "WT08")]

# ---------------------------------------------------------------- units
EARTH_RADIUS_METERS = 6371010.0
MM_PER_INCH = 25.4
MPH_PER_MS = 2.23694
KM_PER_MILE = 1.609344

# ---------------------------------------------------------------- bands, all right-closed
MODEL_TEMP_EDGES = [-100, 32, 45, 55, 65, 75, 85, 200]
MODEL_TEMP_LABELS = ["<32", "32-45", "45-55", "55-65", "65-75", "75-85", "85+"]
MODEL_TEMP_REFERENCE = "55-65"
RAIN_EDGES = [-1, 1e-4, 0.25, 0.75, 100]
RAIN_LABELS = ["dry", "light", "moderate", "heavy"]
DISPLAY_TEMP_EDGES = [-100, 32, 50, 65, 80, 200]
DISPLAY_TEMP_LABELS = ["<32°F", "32–50°F", "50–65°F", "65–80°F", "80°F+"]
HOUR_TEMP_LABELS = ["<32°F", "32–45", "45–55", "55–65", "65–75", "75–85", "85°F+"]
WIND_EDGES = [-1, 5, 9, 13, 100]
WIND_LABELS = ["Calm <5", "Breezy 5–9", "Windy 9–13", "Gale 13+"]
COMFORT_EDGES = [-100, 60, 70, 200]
COMFORT_LABELS = ["Pleasant <60°F", "Sticky 60–70°F", "Oppressive 70°F+"]

# Inclusive hour ranges.
DAYPARTS = [
    (0, 6, "overnight 12–6a"),
    (7, 9, "AM rush 7–9a"),
    (10, 15, "midday 10a–3p"),
    (16, 19, "PM rush 4–7p"),
    (20, 23, "evening 8–11p"),
]

# ---------------------------------------------------------------- estimators
HEAVY_RAIN_INCHES = 0.10
RAIN_LEADS = 2
RAIN_LAGS = 4
HAC_MAX_LAGS = 14
INTERVAL_Z = 1.96
WARM_DAY_F = 68
HUMIDITY_MIN_ROWS = 100
WINDY_DAY_MPH = 10
RAIN_CAP_INCHES = 1.25
SNOW_CAP_INCHES = 6.0
CLIMATOLOGY_DRIVERS = [
    "tavg_f", "wind_avg_mph", "prcp_cap", "rain01", "snow_cap",
    "snow_depth_inches", "is_thunder", "is_foggy",
]
MIN_YEAR_DAYS = 300
MIN_YEAR_MONTHS = 10

# ---------------------------------------------------------------- segments of the trip marts
# segment -> (trips, member, casual) columns and the station regions behind it
SEGMENTS = {
    "NYC + Jersey City": ("num_trips", "num_member_trips", "num_casual_trips", ("NYC", "JC")),
    "NYC only": ("num_nyc_trips", "num_member_trips_nyc", "num_casual_trips_nyc", ("NYC",)),
    "Jersey City only": ("num_jc_trips", "num_member_trips_jc", "num_casual_trips_jc", ("JC",)),
}

# (output column, condition on the canonical trip row)
TRIP_COUNTS = [
    ("num_member_trips", "member_casual = 'member'"),
    ("num_casual_trips", "member_casual = 'casual'"),
    ("num_member_trips_nyc", "region = 'NYC' AND member_casual = 'member'"),
    ("num_casual_trips_nyc", "region = 'NYC' AND member_casual = 'casual'"),
    ("num_member_trips_jc", "region = 'JC' AND member_casual = 'member'"),
    ("num_casual_trips_jc", "region = 'JC' AND member_casual = 'casual'"),
    ("num_nyc_trips", "region = 'NYC'"),
    ("num_jc_trips", "region = 'JC'"),
    ("num_classic_trips", "rideable_type = 'classic_bike'"),
    ("num_electric_trips", "rideable_type = 'electric_bike'"),
]

# ---------------------------------------------------------------- effect names
EFFECT_GROUPS = {
    "temperature": "Temperature (vs 55–65°F)",
    "rain": "Rain (vs dry)",
    "snow": "Snow",
    "wind": "Wind",
    "storms": "Storms (vs same rain/temp)",
    "humidity": "Humidity (warm days, 2016–24)",
}
