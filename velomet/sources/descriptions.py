"""Column descriptions of the daily weather marts."""

_CALENDAR = {
    "date": "Calendar date; one row per station and day.",
    "year": "Year of the date.",
    "month": "Month of the date, 1 to 12.",
    "day": "Day of the month, 1 to 31.",
    "day_of_week": "Day of the week, 1 = Sunday to 7 = Saturday.",
    "is_weekend": "1 on Saturday and Sunday, else 0.",
    "season": "Meteorological season: Winter, Spring, Summer or Fall.",
}
_STATION = {
    "station_id": "Stable station identifier.",
    "station_name": "Station name.",
    "city": "City of the ZIP area that contains the station.",
    "state": "State code of the station.",
    "zip_code": "ZIP area that contains the station.",
    "county_name": "County that contains the station.",
    "longitude": "Station longitude, degrees.",
    "latitude": "Station latitude, degrees.",
    "geo_coord": "Station location as a (lon, lat) struct.",
}
_METRIC = {
    "tmin_c": "Lowest temperature, degrees Celsius.",
    "tmax_c": "Highest temperature, degrees Celsius.",
    "tavg_c": "Mean temperature, degrees Celsius; middle of low and high where no mean is reported.",
    "prcp_mm": "Precipitation, mm; NULL when not reported.",
    "snow_mm": "New snowfall, mm; NULL when not reported.",
    "snow_depth_mm": "Snow on the ground, mm; NULL when not reported.",
    "dewpoint_c": "Mean dew point, degrees Celsius.",
    "wetbulb_c": "Mean wet-bulb temperature, degrees Celsius.",
    "station_pressure_hpa": "Mean station pressure, hPa.",
    "wind_avg_ms": "Mean wind speed, m/s.",
    "wind_gust_ms": "Fastest two-minute wind, m/s.",
    "heating_degree_days": "Degrees Fahrenheit the mean lies below 65.",
    "cooling_degree_days": "Degrees Fahrenheit the mean lies above 65.",
}
_IMPERIAL = {
    "tmin_f": "Lowest temperature, degrees Fahrenheit.",
    "tmax_f": "Highest temperature, degrees Fahrenheit.",
    "tavg_f": "Mean temperature, degrees Fahrenheit.",
    "prcp_inches": "Precipitation, inches; NULL when not reported, 0 on a dry day.",
    "snow_inches": "New snowfall, inches; NULL when not reported.",
    "is_rainy": "1 with measurable precipitation, 0 without, NULL when not reported.",
    "is_snowy": "1 with measurable snowfall, 0 without, NULL when not reported.",
    "is_hot_day": "1 when the high passed 90 F, 0 if not, NULL when not reported.",
    "is_freezing": "1 when the low was under 32 F, 0 if not, NULL when not reported.",
    "snow_depth_inches": "Snow on the ground, inches; NULL when not reported.",
    "rh_avg": "Mean relative humidity, percent.",
    "rh_min": "Lowest relative humidity, percent.",
    "rh_max": "Highest relative humidity, percent.",
    "is_humid": "1 at 70 percent mean humidity or more, 0 below, NULL when not reported.",
    "dewpoint_f": "Mean dew point, degrees Fahrenheit.",
    "wetbulb_f": "Mean wet-bulb temperature, degrees Fahrenheit.",
    "sea_level_pressure_hpa": "Mean sea-level pressure, hPa.",
    "wind_avg_mph": "Mean wind speed, mph.",
    "wind_gust_mph": "Fastest two-minute wind, mph.",
    "wind_dir_deg": "Direction of the fastest two-minute wind, degrees from north.",
    "is_foggy": "1 when fog was observed, else 0.",
    "is_thunder": "1 when thunder was observed, else 0.",
    "is_hazy": "1 when smoke or haze was observed, else 0.",
}

COLUMN_DESCRIPTIONS = {
    "weather_daily": {**_CALENDAR, **_STATION, **_METRIC, **_IMPERIAL},
    "weather_daily_nyc": {**_CALENDAR, **_IMPERIAL},
}
