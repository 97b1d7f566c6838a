"""Named datasets and reports: functions from DataFrames to a DataFrame, no action."""
