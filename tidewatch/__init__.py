"""Tidewatch: time-series cleaning, features and anomaly detection as Spark jobs."""
