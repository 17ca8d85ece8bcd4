"""Readers: driver tables, stand-in feed inputs, Kafka, files."""
