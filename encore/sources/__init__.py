"""Scans, the driver-table binding and sinks."""
