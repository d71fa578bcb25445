from prepline.sources.tables import (
    StageStore, database_options, extract, jdbc_options, range_predicates, read_in_ranges, read_table, write_csv,
)

__all__ = ["StageStore", "database_options", "extract", "jdbc_options", "range_predicates", "read_in_ranges", "read_table", "write_csv"]
