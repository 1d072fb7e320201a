from millrace.functions.columns import audit_columns, int_or_null, row_bytes

__all__ = ["audit_columns", "int_or_null", "row_bytes"]
