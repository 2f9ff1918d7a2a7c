"""Sources and sinks: the CSV feed, the fixture feed, model storage."""

from casetrace.sources.case_feed import (CaseFeed, FeedError, clean_case_records,
                                         load_and_stage, load_case_records, read_case_records, stage,
                                         to_feed_text, write_case_feed)
from casetrace.sources.fixtures import case_records_from_tables

__all__ = ["CaseFeed", "FeedError", "read_case_records", "clean_case_records",
           "load_and_stage", "load_case_records", "stage", "to_feed_text", "write_case_feed",
           "case_records_from_tables"]
