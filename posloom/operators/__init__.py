"""DataFrame-in, DataFrame-out operators.

They build plans. The few that must know something first run one aggregate and
take a single row back: the size of a dimension (``lookup.measured_bytes``), the
filled columns (``filters.drop_empty_columns``).
"""
