"""Operators: DataFrame to DataFrame, no actions unless a bounded replay needs one."""
