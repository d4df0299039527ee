"""Hourly zonal demand tables, features, forecasts and read queries on Spark."""
