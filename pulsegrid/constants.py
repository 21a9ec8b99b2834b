"""Fixed values that results depend on. They must equal the behaviour being reproduced."""

# --- fixed values: event validation -------------------------------------------------------
MIN_HEART_RATE = 20
MAX_HEART_RATE = 250
MIN_MEASUREMENTS = 1
MAX_MEASUREMENTS = 10

# --- fixed values: validation messages (first failing rule wins) ----------------------------
MSG_EVENT_ID_REQUIRED = "event_id is required"
MSG_DEVICE_ID_REQUIRED = "device_id is required"
MSG_PATIENT_ID_REQUIRED = "patient_id is required"
MSG_BATCH_ID_REQUIRED = "batch_id is required"
MSG_TIMESTAMP_REQUIRED = "timestamp is required"
MSG_TIMESTAMP_NOT_UTC = "timestamp must be RFC3339 UTC"
MSG_HR_TOO_LOW = "heart_rate must be greater than or equal to 20"
MSG_HR_TOO_HIGH = "heart_rate must be less than or equal to 250"
MSG_SPO2_RANGE = "spo2 is out of range"
MSG_MEASUREMENTS_LENGTH = "measurements length must be between 1 and 10"
MSG_MEASUREMENT_TS_REQUIRED = "measurement timestamp is required"
MSG_TS_OUT_OF_ORDER = "measurement timestamps must be strictly increasing"
MSG_INVALID_JSON = "invalid JSON body"
MSG_DECODE = "decode kafka message"
MSG_INVALID_EVENT = "invalid telemetry event"

# --- fixed values: detector and alerts ------------------------------------------------------
HIGH_HR_THRESHOLD = 120
HIGH_HR_WINDOW_SECONDS = 60
ALERT_TYPE_HIGH_HR = "HIGH_HEART_RATE"
ALERT_MESSAGE_HIGH_HR = "Patient has high heart rate"
ALERT_BUCKET_SECONDS = 300
ALERT_COOLDOWN_SECONDS = 300
SLIDING_WINDOW_TTL_SECONDS = 300

# --- fixed values: admission control --------------------------------------------------------
RATE_INTERVAL_MS = 5000
RATE_BURST = 2
IDEMPOTENCY_TTL_MS = 24 * 3600 * 1000

# --- fixed values: list queries and retention -----------------------------------------------
LIST_DEFAULT_LIMIT = 100
LIST_MAX_LIMIT = 1000
RETENTION_DAYS = 30

# --- fixed values: topics ---------------------------------------------------------------
RAW_TOPIC = "telemetry.raw"
DLQ_TOPIC = "telemetry.dlq"

# --- fixed values: metrics registry -----------------------------------------------------
# histogram upper bounds (seconds), in order; "+Inf" is appended on output
HISTOGRAM_BOUNDS = [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10]
# the client library's default bounds (seconds), used for request durations of the ingestion service
INGESTION_DURATION_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10]
# name -> (kind, help)
METRIC_DEFINITIONS = {
    "processing_kafka_messages_total": ("counter", "Kafka messages handled by processing, labeled by status."),
    "processing_kafka_commits_total": ("counter", "Kafka offset commit attempts, labeled by status."),
    "processing_dlq_messages_total": ("counter", "Kafka messages written to the processing DLQ, labeled by reason."),
    "processing_alerts_created_total": ("counter", "Alerts created by processing, labeled by alert type."),
    "processing_errors_total": ("counter", "Processing errors, labeled by pipeline stage."),
    "processing_kafka_consumer_lag": (
        "gauge", "Approximate Kafka consumer lag from the last fetched message high watermark."),
    "processing_processing_duration_seconds": ("histogram", "End-to-end processing duration for one Kafka message."),
    "processing_postgres_write_duration_seconds": ("histogram", "PostgreSQL write latency, labeled by operation."),
    "processing_redis_duration_seconds": ("histogram", "Redis operation latency, labeled by operation."),
    "processing_sliding_window_events_current": ("gauge", "Number of events in the latest processed sliding window."),
}
MAX_LATENCY_MS = 60000
