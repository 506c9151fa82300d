from .tables import TABLES, read_table, nan_to_null, with_row_id  # noqa: F401
