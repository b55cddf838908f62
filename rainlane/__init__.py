"""rainlane: daily weather x incident analytics as PySpark DataFrame operators.

Raw zone (JSON series, CSV and JDBC extracts) -> trusted zone (typed, joined
parquet) -> refined zone (statistics, chart datasets, model reports,
predictions), served by name.
"""
