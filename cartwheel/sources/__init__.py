"""Scans, bindings of the driver tables to the reference's shapes, and sinks."""
