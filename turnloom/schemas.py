"""Table schemas, enumerations and additive migration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Required columns of a raw export and the row states.
RAW_COLUMNS = ("Broadcast Date", "Broadcast Time", "Program Title", "Channel Name", "Plain Text")
STATUSES = (
    "PENDING", "PUNCTUATED", "RELEVANT", "NOT RELEVANT", "SEGMENTED", "ATTRIBUTED",
    "FAILED PUNCTUATION", "FAILED COUNT", "FAILED RELEVANCE", "FAILED SEGMENTATION", "FAILED ATTRIBUTION",
)
BLOCK_STATUSES = ("BLOCKED_PUNCTUATION", "BLOCKED_RELEVANCE", "BLOCKED_SEGMENTATION", "BLOCKED_ATTRIBUTION", "BLOCKED_VERIFICATION")
PUNCTUATION_SOURCES = ("llm", "local", "raw")
SIZE_LABELS = ("OVER", "UNDER")

TABLES: dict[str, str] = {
    "grouped": "group_id string, broadcast_date string, broadcast_time string, program_title string, channel_name string, plain_text string, "
    "program_id string, status string, size_label string, block_status string, punctuation_source string",
    "segments": "segment_id string, group_id string, program_id string, broadcast_time string, order_index int, text string",
    "dialogues": "dialogue_id string, group_id string, program_id string, broadcast_time string, dialogue string, speaker string, role string, "
    "confidence_score double, verification_score double, block_status string, order_index int, speaker_type string, note string",
    "final": "window_id bigint, program_title string, channel_name string, broadcast_date string, broadcast_time string, duration_min double, "
    "n_segments int, speakers string, stitched_dialogue string, diarized_dialogue string",
    "person_bio": "row_id string, group_id string, program_id string, broadcast_time string, plain_text string, person string, role string, context_of_mention string",
}
KEYS = {"grouped": "group_id", "segments": "segment_id", "dialogues": "dialogue_id", "final": "window_id", "person_bio": "row_id"}
REQUIRED = {"grouped": ("group_id", "broadcast_date", "broadcast_time", "program_title", "channel_name", "plain_text"), "dialogues": ("dialogue_id", "group_id", "dialogue")}


def schema(table: str) -> StructType:
    return StructType.fromDDL(TABLES[table])


def migrate(df: DataFrame, table: str) -> DataFrame:
    """Bring ``df`` to the table's schema: missing columns as typed nulls, columns it no longer has dropped."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema(table).fields])


def missing_columns(df: DataFrame, required: tuple[str, ...] = RAW_COLUMNS) -> list[str]:
    return [c for c in required if c not in df.columns]


def require_columns(df: DataFrame, required: tuple[str, ...] = RAW_COLUMNS) -> DataFrame:
    gone = missing_columns(df, required)
    if gone:
        raise ValueError(f"missing columns: {', '.join(gone)}")
    return df
