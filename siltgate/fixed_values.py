"""Word lists, patterns, messages and table layouts.

Results depend on these exact values, so they are kept together and written
out plainly.
"""

# Source types and the version every built-in rule set is registered under.
CSV = "csv"
API = "api"
MONGO = "mongo"
SOURCE_TYPES = (CSV, API, MONGO)
DEFAULT_VERSION = "v1"

# Accepted words.
STATUSES = ("active", "inactive", "suspended", "pending")
OPT_IN_TRUE = ("yes", "y", "true", "1")
OPT_IN_FALSE = ("no", "n", "false", "0")
ACTIVE_TRUE = ("true", "1", "yes")
ACTIVE_FALSE = ("false", "0", "no")
STRICT_TRUE = ("1", "on", "t", "true", "y", "yes")
STRICT_FALSE = ("0", "off", "f", "false", "n", "no")

# Age limits: values outside 1..150 are stored as NULL.
MAX_AGE = 150

# Column or key names whose values are redacted (searched anywhere, any case).
SENSITIVE_NAME = r"password|secret|token|api[_-]?key|auth"
REDACTED = "[REDACTED]"

# Landed API responses.
AUTH_STATUSES = (401, 403)
RETRY_STATUSES = (429, 500, 502, 503, 504)
MAX_RETRIES = 3
BACKOFF_SECONDS = 1.0
BODY_EXCERPT = 300

# The characters Python's str.strip() removes.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Error messages, by error code.
MESSAGES = {
    "missing": "Field required",
    "string_type": "Input should be a valid string",
    "string_too_short": "String should have at least {n} character{s}",
    "int_type": "Input should be a valid integer",
    "int_parsing": "Input should be a valid integer, unable to parse string as an integer",
    "int_parsing_size": "Unable to parse input string as an integer, exceeded maximum size",
    "int_from_float": "Input should be a valid integer, got a number with a fractional part",
    "finite_number": "Input should be a finite number",
    "float_type": "Input should be a valid number",
    "greater_than_equal": "Input should be greater than or equal to {n}",
    "bool_type": "Input should be a valid boolean",
    "bool_parsing": "Input should be a valid boolean, unable to interpret input",
    "date_type": "Input should be a valid date",
    "date_from_datetime_parsing": "Input should be a valid date or datetime",
    "date_from_datetime_inexact": "Datetimes provided to dates should have zero time - e.g. be exact dates",
    "datetime_type": "Input should be a valid datetime",
    "datetime_from_date_parsing": "Input should be a valid datetime or date",
}

# What a value_error says after "Value error, "; values that failed follow where a text ends in a blank.
VALUE_ERRORS = {
    "null": "field is required and must not be None",
    "required": "{field} is required",
    "blank": "{field} must not be blank",
    "email": "email is malformed{hint}: ",
    "status": "status must be one of {{{allowed}}}, got: ",
    "opt_in": "{field} must be yes/no/true/false/y/n/1/0, got: ",
    "active": "is_active must be a boolean, got: ",
    "date": "{field} must be YYYY-MM-DD, got: ",
    "moment": "datetime field must be ISO format, got: ",
    "order": "updated_at must be equal to or after created_at",
}
STRICT_EMAIL_ERROR = "value is not a valid email address"
EMAIL_HINT = " (missing @ or domain)"

# Errors of pages and of CSV rows.
NOT_JSON = "Response body is not valid JSON"
NEITHER = "Normalized response payload is neither a list nor an object."
SHORT_ROW = "Row has missing column value(s)."

# Target tables: columns in order with their stored types, and the key.
TARGET_TABLES = {
    "etl_csv_users": (
        "user_id",
        "user_id string, full_name string, email string, phone string, signup_date date, "
        "country string, age int, status string, is_active boolean, newsletter_opt_in boolean, "
        "source string, source_type string, validated_at string, updated_at timestamp",
    ),
    "etl_mongo_users": (
        "user_id",
        "user_id int, first_name string, last_name string, full_name string, email string, "
        "phone string, gender string, date_of_birth string, city string, country string, "
        "address string, is_active boolean, signup_source string, membership string, "
        "created_at string, updated_at string, source string, source_type string, "
        "validated_at string, etl_updated_at timestamp",
    ),
    "etl_api_products": (
        "product_id",
        "product_id int, title string, description string, category string, "
        "price decimal(10,2), discount_percentage decimal(5,2), rating decimal(3,2), stock int, "
        "tags string, brand string, sku string, weight decimal(8,2), width decimal(8,2), "
        "height decimal(8,2), depth decimal(8,2), warranty_information string, "
        "shipping_information string, availability_status string, in_stock boolean, "
        "return_policy string, minimum_order_quantity int, barcode string, created_at string, "
        "updated_at string, thumbnail string, source string, source_type string, "
        "validated_at string, etl_updated_at timestamp",
    ),
    "etl_metadata": (
        "source_name",
        "source_name string, last_successful_run timestamp, last_processed_id string, "
        "last_processed_timestamp timestamp, updated_at timestamp",
    ),
}

# The column each target fills with the load time.
LOAD_TIME_COLUMN = {
    "etl_csv_users": "updated_at",
    "etl_mongo_users": "etl_updated_at",
    "etl_api_products": "etl_updated_at",
}
