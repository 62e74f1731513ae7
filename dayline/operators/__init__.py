"""DataFrame in, DataFrame out; only the polygon join runs a (small) job, to measure its cells.

Series operators take daily tables: at most one row per ``keys`` and date (``aggregates.daily``
makes them, with map-side combine). A window over one series is then as long as the calendar,
however many raw rows stand behind it.
"""
