"""Incremental loading of newly arriving feed files."""

from casetrace.streaming.ingest import (FEED_TEXT_SCHEMA, append_batch, feed_stream,
                                        read_appended_model, start_ingest)

__all__ = ["FEED_TEXT_SCHEMA", "feed_stream", "append_batch", "start_ingest",
           "read_appended_model"]
