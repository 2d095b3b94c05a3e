"""Fixed values that must equal the reference's for right results."""

# --- fixed values ---------------------------------------------------------
# Stations the services batch is driven by (code, name).
STATIONS = [
    ("BRI", "Bristol Temple Meads"),
    ("WAT", "London Waterloo"),
    ("BHM", "Birmingham New Street"),
    ("NCL", "Newcastle"),
    ("YRK", "York"),
    ("MAN", "Manchester Piccadilly"),
    ("LIV", "Liverpool Lime Street"),
    ("LDS", "Leeds"),
    ("PAD", "London Paddington"),
    ("SHF", "Sheffield"),
]

# Seed rows of the service_type dimension, in insertion order.
SERVICE_TYPES = ["bus", "train"]

# displayAs values that mark the terminal call of a service.
TERMINAL_DISPLAY = ["TERMINATES", "DESTINATION"]
CANCELLED_DISPLAY = "CANCELLED_CALL"

# XML namespaces of incident messages.
NS_COMMON = "http://nationalrail.co.uk/xml/common"
NS_INCIDENT = "http://nationalrail.co.uk/xml/incident"

# Operator codes that receive alerts.
ALERT_OPERATOR_CODES = [
    "LO", "VT", "CC", "CS", "CH", "XC",
    "EM", "XR", "ES", "GC", "LE", "GW",
    "HX", "HT", "GR", "LD", "ME", "NT",
    "SR", "SE", "TP", "AW", "LM", "GX",
    "GN", "SN", "TL", "SW", "IL",
]

# Operators appended to the scraped operator table (name, code, satisfaction %).
EXTRA_OPERATORS = [
    ("Gatwick Express", "GX", 80.0),
    ("Great Northern", "GN", 80.0),
    ("Southern", "SN", 80.0),
    ("Thameslink", "TL", 80.0),
    ("South Western Railway", "SW", 75.0),
    ("Island Line", "IL", 75.0),
]
# Known bad rows (0-based data rows) of the one captured operator page.
KNOWN_BAD_OPERATOR_ROWS = [9, 21]
OPERATOR_SATISFACTION_HEADER = "Passenger satisfaction[1]"
OPERATOR_SATISFACTION_COLUMN = "Passenger satisfaction (%)"

# Rows of a top-k chart.
TOP_K = 20
NO_REASON = "None filled out"
REACHED = "Reached"
NOT_REACHED = "Not Reached"
# ---------------------------------------------------------------------------
