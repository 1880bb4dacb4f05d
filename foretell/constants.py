"""Fixed values of the scoring domain.

Everything in this module must equal the published rules exactly for results
to be right; it holds data only, no logic.
"""

# -- fixed values: WMO weather-code groups ------------------------------------
RAIN_CODES = (51, 53, 55, 56, 57, 61, 63, 65, 66, 67, 80, 81, 82)
SNOW_CODES = (71, 73, 75, 77, 85, 86)
FOG_CODES = (45, 48)
HAIL_CODES = (96, 99)
CLEAR_CODES = (0, 1)
CLOUDY_CODES = (2, 3)

# -- fixed values: base rate per market type, and the one for any other type ---
BASE_RATES = {
    "RAIN": 0.35,
    "SNOW": 0.15,
    "TEMPERATURE": 0.50,
    "SUNSHINE": 0.55,
    "WIND": 0.40,
    "FOG": 0.20,
    "HAIL": 0.10,
    "FROST": 0.20,
    "WEATHER": 0.40,
}
DEFAULT_BASE_RATE = 0.40

# -- fixed values: alert thresholds --------------------------------------------
ACCURACY_FLOOR = 0.80
BIAS_CEILING = 0.30
MIN_PREDICTIONS = 10
BASELINE_DAYS = 7
BASELINE_MIN_POINTS = 3
SIGMAS = 2.0
COVERAGE_TARGET = 0.95
COVERAGE_CRITICAL = 0.70
SILENCE_MINUTES = 10
SILENCE_CRITICAL_MINUTES = 30
MISPRICING_DEVIATION = 0.40
MISPRICING_CRITICAL = 0.50
CROSS_MARKET_EXCESS = 0.01
CROSS_MARKET_CRITICAL_MARGIN = 5.0
EXPECTED_PRODUCERS = ("manifold_producer", "weather_producer")

# -- fixed values: enumerations of the stored tables ---------------------------
SEVERITIES = ("low", "medium", "high", "critical")
ALERT_TYPES = (
    "accuracy_drop",
    "arbitrage_opportunity",
    "producer_down",
    "low_coverage",
    "bias_detected",
    "producer_timeout",
)
HEALTH_STATUSES = ("healthy", "degraded", "down", "unknown")

# -- fixed values: latency histogram bounds, seconds ---------------------------
LATENCY_BUCKETS = (30, 60, 120, 300, 600, 1800, 3600)

# -- fixed values: market-type word groups, first match wins, text lower-cased --
MARKET_TYPE_WORDS = (
    ("RAIN", "rain|precipitation|drizzle|sleet"),
    ("SNOW", "snow|snowfall|blizzard|sleet|ice storm"),
    (
        "TEMPERATURE",
        "temperature|degrees|celsius|fahrenheit|above|below|exceed|warm|cold|hot"
        "|freeze|frost|heat wave",
    ),
    ("SUNSHINE", "sunny|sunshine|sun"),
    ("WIND", "wind|windy|storm|hurricane|tornado"),
    ("FOG", "fog|foggy|mist|misty"),
    ("HAIL", "hail|hailstorm"),
    ("CLOUD", "cloud|cloudy|overcast"),
    ("FROST", "frost|freeze|freezing"),
)
DEFAULT_MARKET_TYPE = "WEATHER"

# -- fixed values: city patterns, tried in this order --------------------------
CITY_PATTERNS = (
    r"[Ww]ill it (?:rain|snow|precipitate|freeze) in ([A-Z][^,\?\.]+?)(?:\s+on\s+\d|\s+today|\s+tomorrow|\s+tonight|\?|,|\s+in\s+\d)",
    r"[Ww]ill there be (?:rain|snow|precipitation|frost|fog|hail|sunshine|a storm|a blizzard|a hurricane|wind) in ([A-Z][^,\?\.]+?)(?:\s+on\s+\d|\s+today|\s+tomorrow|\?|,)",
    r"[Tt]emperature in ([A-Z][^,\?\.]+?)(?:\s+on\s+\d|\s+today|\s+exceed|\s+be|\?|,)",
    r"[Ww]ill the temperature in ([A-Z][^,\?\.]+?)(?:\s+on\s+\d|\s+today|\s+exceed|\s+be|\?|,)",
    r"[Ww]ill it be (?:sunny|cloudy|overcast|hot|cold|warm|windy|foggy|above|below) in ([A-Z][^,\?\.]+?)(?:\s+on\s+\d|\s+today|\s+tomorrow|\?|,)",
    r"[Ww]ill it be (?:above|below) [\d\.]+ ?(?:degrees|°)?[CF]? in ([A-Z][^,\?\.]+?)(?:\s+on\s+\d|\s+today|\?|,)",
    r"\bin ([A-Z][a-zA-Z\s\-]+?)(?:\s+on\s+\d|\s+today|\s+tomorrow|\?|,)",
)
# the basic cascade has no "above/below N degrees" pattern
DEGREES_PATTERN = 5
CITY_STOP_WORDS = "today|tomorrow|tonight|on|in|at|this|the|before|during|exceed|above|below"
CITY_STOP_WORDS_BASIC = "today|tomorrow|tonight|on|in|at|this|the|before|during"

# -- fixed values: nicknames, lower-cased --------------------------------------
CITY_NICKNAMES = {
    "nyc": "New York City",
    "new york": "New York City",
    "the big apple": "New York City",
    "big apple": "New York City",
    "la": "Los Angeles",
    "chi-town": "Chicago",
    "the windy city": "Chicago",
    "windy city": "Chicago",
    "frisco": "San Francisco",
    "sf": "San Francisco",
    "dc": "Washington",
}
TIME_WORDS = (
    "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday",
    "today", "tomorrow", "tonight", "this", "next", "last", "weekend",
)

# -- fixed values: words removed before a question is hashed -------------------
QUESTION_NOISE = (
    r"\b(today|tomorrow|tonight|yesterday"
    r"|monday|tuesday|wednesday|thursday|friday|saturday|sunday"
    r"|january|february|march|april|may|june|july|august"
    r"|september|october|november|december"
    r"|this week|next week|this weekend|next weekend"
    r"|on \d{4}-\d{2}-\d{2}|on [a-z]+ \d+|\d{4})\b"
)

# -- fixed values: place classes accepted and place types refused --------------
PLACE_CLASSES = ("place", "boundary", "administrative")
REFUSED_PLACE_TYPES = (
    "kiosk", "shop", "footway", "highway", "street",
    "road", "building", "house", "hotel", "restaurant",
    "cafe", "bar", "pub", "park", "garden", "parking",
    "bus_stop", "station", "airport", "ferry_terminal",
)

# -- fixed values: search terms of the market feed, in query order -------------
SEARCH_TERMS = (
    "Will it rain in", "Will there be rain", "rain in",
    "precipitation in", "Will there be precipitation",
    "Will it snow in", "Will there be snow", "snow in",
    "blizzard in", "Will there be a blizzard",
    "temperature in", "Will the temperature",
    "Will it be above", "Will it be below",
    "exceed degrees", "degrees celsius", "degrees fahrenheit",
    "Will it be hot", "Will it be cold", "Will it freeze",
    "Will there be frost", "Will it be sunny",
    "Will there be sunshine", "sunshine in",
    "Will it be cloudy", "Will it be overcast",
    "Will it be windy", "wind in",
    "Will there be a storm", "storm in",
    "Will there be a hurricane", "Will there be a tornado",
    "Will there be fog", "Will there be hail",
    "hail in", "Will it be foggy",
    "heat wave", "Will there be a heat wave",
)

# -- fixed values: timezone of well-known cities -------------------------------
CITY_TIMEZONES = {
    "London": "Europe/London",
    "New York": "America/New_York",
    "New York City": "America/New_York",
    "NYC": "America/New_York",
    "Paris": "Europe/Paris",
    "Berlin": "Europe/Berlin",
    "Tokyo": "Asia/Tokyo",
    "Sydney": "Australia/Sydney",
    "Toronto": "America/Toronto",
    "Warsaw": "Europe/Warsaw",
    "Amsterdam": "Europe/Amsterdam",
    "Moscow": "Europe/Moscow",
    "Dubai": "Asia/Dubai",
    "Singapore": "Asia/Singapore",
    "Chicago": "America/Chicago",
    "Los Angeles": "America/Los_Angeles",
    "San Francisco": "America/Los_Angeles",
    "Miami": "America/New_York",
    "Seattle": "America/Los_Angeles",
    "Denver": "America/Denver",
    "Istanbul": "Europe/Istanbul",
    "Dublin": "Europe/Dublin",
}

# -- fixed values: known coordinates, (city, latitude, longitude, timezone) ----
CITY_COORDINATES = (
    ("London", 51.5074, -0.1278, "Europe/London"),
    ("New York", 40.7128, -74.0060, "America/New_York"),
    ("New York City", 40.7128, -74.0060, "America/New_York"),
    ("NYC", 40.7128, -74.0060, "America/New_York"),
    ("Manhattan", 40.7831, -73.9712, "America/New_York"),
    ("Tokyo", 35.6762, 139.6503, "Asia/Tokyo"),
    ("Seattle", 47.6062, -122.3321, "America/Los_Angeles"),
    ("Paris", 48.8566, 2.3522, "Europe/Paris"),
    ("Berlin", 52.5200, 13.4050, "Europe/Berlin"),
    ("Sydney", -33.8688, 151.2093, "Australia/Sydney"),
    ("Toronto", 43.6532, -79.3832, "America/Toronto"),
    ("Miami", 25.7617, -80.1918, "America/New_York"),
    ("Warsaw", 52.2297, 21.0122, "Europe/Warsaw"),
    ("Amsterdam", 52.3676, 4.9041, "Europe/Amsterdam"),
    ("Dublin", 53.3498, -6.2603, "Europe/Dublin"),
    ("Chicago", 41.8781, -87.6298, "America/Chicago"),
    ("Los Angeles", 34.0522, -118.2437, "America/Los_Angeles"),
    ("San Francisco", 37.7749, -122.4194, "America/Los_Angeles"),
    ("Boston", 42.3601, -71.0589, "America/New_York"),
    ("Denver", 39.7392, -104.9903, "America/Denver"),
    ("Atlanta", 33.7490, -84.3880, "America/New_York"),
    ("Vancouver", 49.2827, -123.1207, "America/Vancouver"),
    ("Montreal", 45.5017, -73.5673, "America/Toronto"),
    ("Calgary", 51.0447, -114.0719, "America/Denver"),
    ("Ottawa", 45.4215, -75.6972, "America/Toronto"),
    ("Manchester", 53.4808, -2.2426, "Europe/London"),
    ("Birmingham", 52.4862, -1.8904, "Europe/London"),
    ("Istanbul", 41.0082, 28.9784, "Europe/Istanbul"),
    ("Moscow", 55.7558, 37.6173, "Europe/Moscow"),
    ("Bratislava", 48.1486, 17.1077, "Europe/Bratislava"),
    ("Zurich", 47.3769, 8.5417, "Europe/Zurich"),
    ("Zürich", 47.3769, 8.5417, "Europe/Zurich"),
    ("Brussels", 50.8503, 4.3517, "Europe/Brussels"),
    ("Vienna", 48.2082, 16.3738, "Europe/Vienna"),
    ("Prague", 50.0755, 14.4378, "Europe/Prague"),
    ("Szczecin", 53.4285, 14.5528, "Europe/Warsaw"),
    ("Madurai", 9.9252, 78.1198, "Asia/Kolkata"),
    ("Anchorage", 61.2181, -149.9003, "America/Anchorage"),
    ("Phoenix", 33.4484, -112.0740, "America/Phoenix"),
    ("Washington", 38.9072, -77.0369, "America/New_York"),
    ("Durham", 35.9940, -78.8986, "America/New_York"),
    ("Austin", 30.2672, -97.7431, "America/Chicago"),
    ("Rockford", 42.2711, -89.0940, "America/Chicago"),
    ("Edmonton", 53.5461, -113.4938, "America/Edmonton"),
    ("Halifax", 44.6488, -63.5752, "America/Halifax"),
    ("Saskatoon", 52.1332, -106.6700, "America/Regina"),
    ("Thunder Bay", 48.3809, -89.2477, "America/Thunder_Bay"),
    ("Prince George", 53.9171, -122.7497, "America/Vancouver"),
    ("Bibinje", 44.0667, 15.2833, "Europe/Zagreb"),
    ("Jerusalem", 31.7683, 35.2137, "Asia/Jerusalem"),
    ("Nicosia", 35.1856, 33.3823, "Asia/Nicosia"),
    ("Ljubljana", 46.0569, 14.5058, "Europe/Ljubljana"),
    ("Chelyabinsk", 55.1644, 61.4368, "Asia/Yekaterinburg"),
    ("Oymyakon", 63.4608, 142.7858, "Asia/Vladivostok"),
    ("West Hollywood", 34.0900, -118.3617, "America/Los_Angeles"),
    ("Berkeley", 37.8716, -122.2727, "America/Los_Angeles"),
    ("Orlando", 28.5383, -81.3792, "America/New_York"),
    ("Westfield", 42.1251, -72.7495, "America/New_York"),
    ("Hamilton", 43.2557, -79.8711, "America/Toronto"),
    ("Kent", 51.2787, 1.0798, "Europe/London"),
    ("Camden", 39.9259, -75.1196, "America/New_York"),
    ("Barriere", 51.1891, -120.1335, "America/Vancouver"),
    ("Banská Štiavnica", 48.4586, 18.8965, "Europe/Bratislava"),
)
