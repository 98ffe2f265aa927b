"""Streaming: intentionally empty.

Every input of the workload is a finite table and the workload has no
watermark, window-over-time, or stateful streaming operator, so there is
nothing to express with Structured Streaming.  The iterative state of the
recursive forecast is kept in checkpointed DataFrames instead
(``footfall.plans.forecast``).
"""
