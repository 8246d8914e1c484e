"""Fixed values of the capture contract.

Everything in this module is a value that results depend on. Nothing here is
tunable by accident: operators take their own keyword arguments and use these
as defaults.
"""

# ---------------------------------------------------------------------------
# Protocols, directions, event codes
# ---------------------------------------------------------------------------
OCPI = "ocpi"
OCPP = "ocpp"

DIRECTION_IN = "IN"
DIRECTION_OUT = "OUT"
DIRECTION_TO_CP = "TO_CP"
DIRECTION_FROM_CP = "FROM_CP"

DISCONNECT = 0
CONNECT = 1
MESSAGE = 2
EVENT_CODES = {"DISCONNECT": DISCONNECT, "CONNECT": CONNECT, "MESSAGE": MESSAGE}

# ---------------------------------------------------------------------------
# redaction
# ---------------------------------------------------------------------------
DEFAULT_HEADER_ALLOWLIST = (
    "ocpi-from-country-code",
    "ocpi-from-party-id",
    "ocpi-to-country-code",
    "ocpi-to-party-id",
    "content-type",
    "accept",
    "user-agent",
    "x-correlation-id",
    "x-request-id",
    "x-total-count",
    "x-limit",
    "link",
)
TOKEN_PLACEHOLDER = "[redacted]"

# A URL that ends in /credentials or /credentials/, or goes on with a query
# string. Java spelling: `\n?\z` and the (?iu) flags give the end-of-string and
# letter-case rules of the contract.
CREDENTIALS_URL_PATTERN = r"(?iu)/credentials/?(?:\?|\n?\z)"

# One character that is not Unicode white space (Java spelling). The ASCII
# separators 0x1c-0x1f count as white space too.
NON_BLANK_PATTERN = r"(?U)[^\s\x1c-\x1f]"
EDGE_BLANKS_PATTERN = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"

# ---------------------------------------------------------------------------
# Limits and defaults of a client
# ---------------------------------------------------------------------------
DEFAULT_BUFFER_CAPACITY = 10_000
DEFAULT_MAX_CAPTURE_BYTES = 65_536
DEFAULT_FLUSH_INTERVAL = 5.0
DEFAULT_DRAIN_TIMEOUT = 10.0
# How often a buffer is looked at.
POLL_INTERVAL = 0.2
DEFAULT_COMPRESSION = "zstd"
COMPRESSIONS = ("gzip", "zstd")

MIN_BUFFER_CAPACITY = 1
MIN_MAX_CAPTURE_BYTES = 1
MIN_FLUSH_INTERVAL = 0.001
MIN_DRAIN_TIMEOUT = 5.0

# ---------------------------------------------------------------------------
# Batches and delivery
# ---------------------------------------------------------------------------
BATCH_CAP = 1_000
COMPRESS_MIN_BYTES = 1_024
MAX_ATTEMPTS = 5
ACCEPTED_STATUS = 200
PERMANENT_STATUSES = (400, 401, 413)

# ---------------------------------------------------------------------------
# Drop reasons, in the order in which they are decided
# ---------------------------------------------------------------------------
INERT_CLIENT = "inert_client"
UNKNOWN_CONNECTION = "unknown_connection"
INCOMPLETE_FRAME = "incomplete_frame"
INVALID_IDENTITY = "invalid_identity"
REQUEST_BODY_OVERSIZE = "request_body_oversize"
RESPONSE_BODY_OVERSIZE = "response_body_oversize"
FRAME_OVERSIZE = "frame_oversize"
REDACT_FAULT = "redact_fault"
RING_OVERFLOW = "ring_overflow"

# Of a record in a batch body that was read back.
UNDECODABLE_BODY = "undecodable_body"

# Of a message that is no capture at all.
UNPARSEABLE = "unparseable"
