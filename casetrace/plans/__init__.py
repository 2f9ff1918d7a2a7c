"""The model builders and the reports."""

from casetrace.plans.model import Model, build_model
from casetrace.plans.reports import REPORTS

__all__ = ["Model", "build_model", "REPORTS"]
