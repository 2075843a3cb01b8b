"""Inputs: text streams, change-event feeds and stored tables."""

from rillhouse.sources.schemas import *  # noqa: F401,F403
from rillhouse.sources.text import (  # noqa: F401
    from_kafka_rows, jdbc_snapshot, kafka_options, kafka_text, replay_text,
    table_snapshot_as_changes,
)
