"""Column names the library adds, and the names payloads may not use."""

# Columns of the structured rows and of the tables.
TIMESTAMP = "timestamp"
VALUE = "value"
VALUE_RAW = "value_raw"
CURRENT = "current"
VALID_TO = "valid_to"
OUTCOME = "outcome"
TOPIC = "topic"
BATCH_ID = "batch_id"
RUN_ID = "run_id"
CORRUPT = "_corrupt_record"

# Kafka partition and offset of the record: the tie-break between rows of one
# key that carry the same timestamp.
RECORD_PARTITION = "record_partition"
RECORD_OFFSET = "record_offset"
POSITION = (RECORD_PARTITION, RECORD_OFFSET)

# Outcomes of a message.
ACCEPTED = "accepted"
MALFORMED = "malformed"
NULL_VALUE = "null_value"
MISSING_REQUIRED = "missing_required"
MISSING_KEY = "missing_key"
NOT_CASTABLE = "not_castable"
UNDECLARED_TOPIC = "undeclared_topic"

RESERVED = frozenset(
    {TIMESTAMP, VALUE_RAW, CURRENT, VALID_TO, OUTCOME, BATCH_ID, RUN_ID, CORRUPT, *POSITION}
)
