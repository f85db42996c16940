"""qsig — search-log and product-category analytics as Spark DataFrame jobs.

Layout:
  sources/    partitioned scans, text/TSV readers, partition sinks, staging
  functions/  column helpers: seeded md5 draws, vector math on arrays
  operators/  terms (TF-IDF), pairs, samples, features, similarity, scoring,
              kmeans (Lloyd), mlkmeans (pyspark.ml), augment, ordering
  plans/      composed jobs, test-table adapters, registered queries
  streaming/  (none needed; see its docstring)
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Functions of this package that run inside tasks (the numpy kernels of
    ``mapInPandas`` / ``applyInPandas``) are pickled by value, so executors
    need numpy and pandas but not this package on their path."""
    import sys

    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover - pyspark without bundled cloudpickle
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
