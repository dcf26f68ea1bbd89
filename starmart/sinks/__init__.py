"""Table writes and CSV / JSON exports."""

from starmart.sinks.writers import export_all, export_csv, export_json, save, save_bucketed, save_table_with_schema

__all__ = ["export_all", "export_csv", "export_json", "save", "save_bucketed", "save_table_with_schema"]
