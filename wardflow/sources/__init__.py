"""Readers, sinks and the stand-in tables used where clinical data is not at hand."""
