"""loglynx: security-event analytics as Spark jobs.

Log scans -> normalised events -> rule evaluation (point and replay mode)
-> suppression -> chains -> reputation / geo -> read-side tables, in batch
and in Structured Streaming with the same DataFrame functions.
"""

__version__ = "0.1.0"
