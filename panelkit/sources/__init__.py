from panelkit.sources.files import read_panel_csv
from panelkit.sources.panel import PANEL_SPEC, derived_panel
from panelkit.sources.sinks import save_model, save_sweep_artifacts, write_report_csv, write_summary_json

__all__ = [
    "PANEL_SPEC", "derived_panel", "read_panel_csv", "save_model", "save_sweep_artifacts",
    "write_report_csv", "write_summary_json",
]
