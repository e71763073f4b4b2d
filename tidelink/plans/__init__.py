"""Query plans: bindings of the operators to the given tables, and the
registry used by ``__spark_entry__`` and ``bench.py``."""
