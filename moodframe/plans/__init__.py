"""Query plans: the operators wired to concrete tables (used by
``__spark_entry__`` and ``bench.py``)."""
