"""Readers, decoders and sinks: stored tables, JSON events, message streams, result/dead-letter sinks, test-data views."""
