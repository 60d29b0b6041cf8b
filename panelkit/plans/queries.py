"""Import every query module so the registry is complete."""

from panelkit.plans import q_long, q_model, q_multi, q_panel, q_prep, q_sources  # noqa: F401
from panelkit.plans.registry import QUERIES

__all__ = ["QUERIES"]
