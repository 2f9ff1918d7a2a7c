"""Operators the model and reports are built from: keys, checks, joins."""

from casetrace.operators.joins import fanout_join
from casetrace.operators.keys import append_new, assign_ids, lookup_id, max_id
from casetrace.operators.quality import ModelError, assert_valid, violations

__all__ = ["assign_ids", "append_new", "lookup_id", "max_id", 
           "fanout_join", "violations",
           "assert_valid", "ModelError"]
