"""Autoregressive models of many series at once.

Spark spreads series and blocks of configurations over tasks and does all scoring; a task gets
one daily series (bounded by the calendar) and solves small least-squares systems.
"""
