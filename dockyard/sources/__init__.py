"""Readers: snapshots, the message topic, stored tables, and the driver's events table."""
