"""panelkit: cleaning, profiling and model evaluation of dirty panel tables on Spark.

Every operator takes a DataFrame (plus a :class:`~panelkit.spec.PanelSpec`) and
returns a DataFrame, so the whole preparation stays one Catalyst plan.
"""

from panelkit.spec import CREDIT_PANEL, PanelSpec

__all__ = ["CREDIT_PANEL", "PanelSpec"]
