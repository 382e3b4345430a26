"""Readers, landing of raw records, and sinks."""
