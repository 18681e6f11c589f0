"""The KPI catalogue: functions from facts and dimensions to result frames."""
