"""No stream operators: every job runs over a closed date range.

The day-at-a-time way of working is covered by ``operators.quality.daily_tasks``
(what to run), ``sources.stores.write_store`` with ``mode="overwrite_days"`` (replace only the
days that were recomputed) and ``operators.quality.day_status`` (what is still missing).
"""
