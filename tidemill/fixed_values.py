"""Constants, patterns and lookup tables that results depend on."""

# Sensor threshold rules (field, kind, limit, unit).
SENSOR_RULES = [
    ("temperatura", "max", 95.0, "°C"),
    ("vibracion", "max", 4.5, "mm/s"),
    ("consumo_kw", "max", 70.0, "kW"),
    ("presion_bar", "min", 2.5, "bar"),
]

# The detector's features and what a missing one counts as.
DETECTOR_DEFAULTS = {
    "temperatura": 75.0,
    "vibracion": 2.5,
    "velocidad_rpm": 1500.0,
    "consumo_kw": 45.0,
    "presion_bar": 6.0,
}

# Nominal operating point per machine (temp, vib, rpm, kw, bar).
MACHINE_NOMINAL = {
    "MAQ-001": (72.0, 2.3, 1480.0, 42.0, 6.1),
    "MAQ-002": (78.0, 2.7, 1520.0, 48.0, 5.9),
    "MAQ-003": (75.0, 2.5, 1500.0, 45.0, 6.0),
    "MAQ-004": (70.0, 2.1, 1460.0, 40.0, 6.2),
    "MAQ-005": (80.0, 3.0, 1550.0, 52.0, 5.8),
}

# Accent folding, character for character (the last two are a known quirk).
ACCENTS_FROM = "áéíóúüàèìòùâêîôûãñ"
ACCENTS_TO = "aeiouuaeiouaeiouän"

# Domain words added to the Spanish stopword list.
EXTRA_STOPWORDS = ["favor", "porfavor"]

# Words read as yes, as no, as a help request, and as a wish to leave a dialogue.
YES_WORDS = ["si", "sí", "yes", "claro", "correcto", "exacto", "afirmativo", "ok", "sip"]
NO_WORDS = ["no", "nope", "negativo", "tampoco", "para nada"]
HELP_WORDS = ["ayuda", "help", "menu", "menú", "opciones", "temas", "qué puedes hacer"]
CANCEL_WORDS = ["cancelar", "salir", "volver", "parar"]

# Guided dialogue flows as (flow, state, answer, next state); no next state ends the flow.
DIALOGUE_STEPS = [
    ("problema_wifi", "wifi", "si", "wifi_otros"),
    ("problema_wifi", "wifi", "no", None),
    ("problema_wifi", "wifi_otros", "si", None),
    ("problema_wifi", "wifi_otros", "no", None),
    ("computadora_lenta", "lenta", "inicio", "lenta_disco"),
    ("computadora_lenta", "lenta", "programas", None),
    ("computadora_lenta", "lenta_disco", "si", None),
    ("computadora_lenta", "lenta_disco", "no", None),
    ("no_enciende", "enciende", "si", "enciende_pantalla"),
    ("no_enciende", "enciende", "no", None),
    ("no_enciende", "enciende_pantalla", "si", None),
    ("no_enciende", "enciende_pantalla", "no", None),
]

# Intents not listed as frequent questions.
HIDDEN_INTENTS = ["saludo", "despedida", "agradecimiento"]

# Star words on item pages.
STAR_WORDS = {"One": 1, "Two": 2, "Three": 3, "Four": 4, "Five": 5}

# Number words of the car table.
NUMBER_WORDS = {"two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "eight": 8, "twelve": 12}

# What to assume where the monthly weather is missing.
WEATHER_DEFAULTS = {"avg_temp_c": 15.0, "rain_mm": 30.0}

# Feature columns of the demand models.
DEMAND_FEATURES = [
    "product_id", "store_id", "year", "month", "day", "day_of_week",
    "week_of_year", "is_weekend", "quarter", "unit_price", "discount_pct",
    "lag_7", "lag_14", "lag_30", "roll_7", "roll_30",
    "avg_temp_c", "rain_mm",
]

# Thresholds of the reports and models.
PRICE_ALERT_PCT = 10.0
INTENT_MIN_CONFIDENCE = 0.35
UNKNOWN_INTENT = "desconocido"
WEEKDAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Weather station of each airport.
STATION_AIRPORTS = {
    "USW00023174": "LAX",
    "USW00012960": "IAH",
    "USW00003017": "DEN",
    "USW00094846": "ORD",
    "USW00013874": "ATL",
    "USW00023234": "SFO",
    "USW00003927": "DFW",
    "USW00023183": "PHX",
    "USW00013881": "CLT",
}

# Public holidays 2014 to 2018 that mark a flight date.
HOLIDAYS = [
    "2014-01-01", "2014-01-20", "2014-02-17", "2014-05-26", "2014-07-04",
    "2014-09-01", "2014-10-13", "2014-11-11", "2014-11-27", "2014-12-25",
    "2015-01-01", "2015-01-19", "2015-02-16", "2015-05-25", "2015-06-03", "2015-07-04",
    "2015-09-07", "2015-10-12", "2015-11-11", "2015-11-26", "2015-12-25",
    "2016-01-01", "2016-01-18", "2016-02-15", "2016-05-30", "2016-07-04",
    "2016-09-05", "2016-10-10", "2016-11-11", "2016-11-24", "2016-12-25", "2016-12-26",
    "2017-01-02", "2017-01-16", "2017-02-20", "2017-05-29", "2017-07-04",
    "2017-09-04", "2017-10-09", "2017-11-10", "2017-11-23", "2017-12-25",
    "2018-01-01", "2018-01-15", "2018-02-19", "2018-05-28", "2018-07-04",
    "2018-09-03", "2018-10-08", "2018-11-12", "2018-11-22", "2018-12-25",
]
