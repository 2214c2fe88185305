from panelwright.sinks.files import write_ordered_csv, write_result_csv
from panelwright.sinks.store import PanelStore, conform

__all__ = ["PanelStore", "conform", "write_ordered_csv", "write_result_csv"]
