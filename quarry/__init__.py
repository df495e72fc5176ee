"""quarry — config-driven ELT on Spark DataFrames.

Turns raw nested records into typed, deduplicated warehouse tables:
flatten, deduplicate, map, project with SQL, normalise text, upsert.
"""

from .functions.text import capitalize, regex_rules, truncate_width, upper_unaccent
from .functions.times import (epoch_ms_to_text, epoch_ms_to_timestamp, epoch_ms_to_timestamp_exact,
                              epoch_ms_to_timestamp_ntz)
from .operators.conform import conform, empty_like
from .operators.dedup import deduplicate, keep_latest
from .operators.flatten import coalesce_choice, flatten_all, flatten_struct
from .operators.mapping import apply_mapping, parse_mapping
from .operators.projection import named_projection, sql_projection
from .operators.quality import key_constraint_report, row_count_gate
from .operators.upsert import upsert_guarded, upsert_replace
from .plans.pipeline import PipelineConfig, run_batch, run_pipeline
from .session import build_session
from .sinks.publish import publish_upsert, read_bucketed

__all__ = [
    "PipelineConfig", "build_session", "publish_upsert", "read_bucketed", "run_batch", "run_pipeline",
    "apply_mapping", "capitalize", "coalesce_choice", "conform", "deduplicate", "empty_like",
    "epoch_ms_to_text", "epoch_ms_to_timestamp", "epoch_ms_to_timestamp_exact", "epoch_ms_to_timestamp_ntz",
    "flatten_all", "flatten_struct", "keep_latest", "key_constraint_report", "named_projection",
    "parse_mapping", "regex_rules", "row_count_gate", "sql_projection", "truncate_width", "upper_unaccent",
    "upsert_guarded", "upsert_replace",
]
