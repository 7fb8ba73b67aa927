"""Streaming: intentionally empty.

The reference has no streams, watermarks, windows over event time or state;
its only re-runnable step is "convert what is not converted yet", which is the
batch left-anti join in ``tessera.queries.missing_targets`` / ``plans.jobs``.
Nothing is built here so as not to invent behaviour the reference lacks.
"""
