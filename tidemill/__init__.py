"""tidemill: prepare, profile and forecast many time series with PySpark.

Every operator takes a DataFrame plus the names of the series key columns and of
the time column, and returns a DataFrame.
"""
