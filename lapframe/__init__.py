"""Timed-event competition analytics as composable PySpark DataFrame functions."""
