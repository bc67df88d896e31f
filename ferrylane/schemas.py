"""Schemas of the control tables, and the words used in them."""

from __future__ import annotations

# The vocabulary of stages, statuses and outcomes.
STAGE_PIPELINE = "pipeline"
STAGE_EXTRACTION = "extraction"
STAGE_UPLOAD = "upload"
STAGE_TRANSFER = "transfer"
STAGE_LOAD = "load"

STARTED = "STARTED"
SUCCESS = "SUCCESS"
FAILED = "FAILED"
SKIPPED = "SKIPPED"
IN_PROGRESS = "IN_PROGRESS"
COMPLETED = "COMPLETED"
PARTIAL_FAILURE = "PARTIAL_FAILURE"
RESUMED_SUCCESS = "RESUMED_SUCCESS"
SUCCESS_LANDED_ONLY = "SUCCESS_LANDED_ONLY"

FULL = "full"
INCREMENTAL = "incremental"
LOAD_MODES = (FULL, INCREMENTAL)


# Control tables, as DDL text.
LOG = (
    "run_id string, table_name string, schema_name string, stage string, status string, "
    "batch_index bigint, rows_processed bigint, bytes_processed bigint, "
    "started_at timestamp, finished_at timestamp, error_message string, extra_json string"
)

CHECKPOINT = (
    "table_name string not null, schema_name string, last_pk_json string, "
    "last_batch_index bigint, status string, run_id string, updated_at timestamp"
)

AUDIT = (
    "run_id string, table_name string, schema_name string, load_mode string, outcome string, "
    "batches_processed bigint, rows_processed bigint, resumed_from_batch bigint, "
    "started_at timestamp, finished_at timestamp, error_message string"
)

REPORT = (
    "table_name string, schema_name string, target_dataset string, load_mode string, "
    "last_run_outcome string, last_run_rows_processed bigint, "
    "last_run_started_at timestamp, last_run_finished_at timestamp, "
    "last_error_message string, total_rows_in_target bigint, report_generated_at timestamp"
)

# Catalog frames, one row per object of every region.
TABLES = "region string, table_schema string, table_name string, table_type string"
COLUMNS = (
    "region string, table_schema string, table_name string, column_name string, "
    "data_type string, numeric_precision int, numeric_scale int, ordinal_position int"
)
CONSTRAINTS = (
    "region string, table_schema string, table_name string, constraint_name string, "
    "constraint_type string"
)
KEY_COLUMNS = (
    "region string, table_schema string, constraint_name string, column_name string, "
    "ordinal_position int"
)
OVERRIDES = (
    "position int, schema string, name string, region string, load_mode string, exclude boolean"
)
REGIONS = "region string, host string, location string"
