"""Readers and writers; XYZ inside Spark, TMS only inside archives."""
