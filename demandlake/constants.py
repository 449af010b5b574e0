"""Fixed values shared by the operators.

The values below must equal the ones the export format and the original tool
use, so they are spelled out here in their natural order.
"""

# --- fixed values: report kinds in their significant declaration order -----
VIEWS = ("top_popular", "top_related", "dynamics", "regions")

# --- fixed values: granularities ---------------------------------------------
GRANULARITIES = ("monthly", "weekly", "daily")

# --- fixed values: Russian month names (nominative, then genitive) ----------
MONTHS_NOMINATIVE = (
    "январь", "февраль", "март", "апрель", "май", "июнь",
    "июль", "август", "сентябрь", "октябрь", "ноябрь", "декабрь",
)
MONTHS_GENITIVE = (
    "января", "февраля", "марта", "апреля", "мая", "июня",
    "июля", "августа", "сентября", "октября", "ноября", "декабря",
)

# --- fixed values: error codes (one per failure class) ----------------------
INVALID_REQUEST = "INVALID_REQUEST"
INVALID_PERIOD = "INVALID_PERIOD"
AUTH_REQUIRED = "AUTH_REQUIRED"
INTERFACE_CHANGED = "INTERFACE_CHANGED"
PHRASE_ENTRY = "PHRASE_ENTRY"
DOWNLOAD_TIMEOUT = "DOWNLOAD_TIMEOUT"
DOWNLOAD_ESCAPED = "DOWNLOAD_ESCAPED"
CSV_FORMAT = "CSV_FORMAT"
RESUME_MISMATCH = "RESUME_MISMATCH"
OVERFLOW = "OVERFLOW"

# --- fixed values: error class names in "<Type>: <message>" texts ------------
ERROR_TYPES = {
    INVALID_REQUEST: "InvalidRequestError",
    INVALID_PERIOD: "InvalidPeriodError",
    AUTH_REQUIRED: "AuthenticationRequiredError",
    INTERFACE_CHANGED: "InterfaceChangedError",
    PHRASE_ENTRY: "PhraseEntryError",
    DOWNLOAD_TIMEOUT: "DownloadTimeoutError",
    DOWNLOAD_ESCAPED: "DownloadEscapedError",
    CSV_FORMAT: "CsvFormatError",
    RESUME_MISMATCH: "ResumeMismatchError",
    OVERFLOW: "OverflowError",
}

# --- fixed values: period rules ----------------------------------------------
EARLIEST_DATE = "2018-01-01"
DAILY_MAX_SPAN_DAYS = 60
DAILY_MAX_AGE_DAYS = 60
WEEKLY_MIN_SPAN_DAYS = 20

# --- fixed values: CSV dialect -------------------------------------------------
SNIFF_DELIMITERS = (";", ",", "\t")        # candidates the sniffer may elect
PREFERRED_DELIMITERS = (",", "\t", ";")    # tie order among elected candidates
FALLBACK_DELIMITERS = (";", "\t")          # header-only rule, ';' wins ties
SNIFF_SAMPLE_CHARS = 4096
SNIFF_CHUNK_LINES = 10
SLUG_MAX_CHARS = 64
DEFAULT_SLUG = "query"
# --- fixed values: texts of the incomplete report ------------------------------
NOT_COLLECTED = "не собран"
NOT_ATTEMPTED_PREFIX = "не пробовался: сбой на виде "

# Largest magnitude an int64 keeps exactly inside a float64 column.
FLOAT64_EXACT_INT = 2 ** 53


def sniff_consistency_levels() -> tuple[float, ...]:
    """Consistency thresholds tried by the delimiter sniffer, highest first.

    Built by the same float rule the sniffer uses (start at 1.0, step down by
    0.01 while >= 0.9), so the exact binary values match.
    """
    levels = []
    level = 1.0
    while level >= 0.9:
        levels.append(level)
        level -= 0.01
    return tuple(levels)
