"""Readers, the test-data binding and sinks."""
