"""Reservation, occupancy and pricing analytics as Spark DataFrame functions."""

__version__ = "0.1.0"
