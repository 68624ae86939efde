"""Streaming entry points.

The modelled jobs have no streaming operators; they run once a day on the
snapshot of that day.  ``run_landed_days`` is the Structured Streaming way to
drive that same batch job: it reacts to "snapshot landed" markers, runs the
job once per new day, and remembers progress in a checkpoint, so a restart
neither skips nor repeats a day (the jobs' writes are repeatable anyway).
"""

from ledgerline.streaming.daily import MARKER_SCHEMA, run_landed_days, write_marker

__all__ = ["MARKER_SCHEMA", "run_landed_days", "write_marker"]
