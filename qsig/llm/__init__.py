"""Training-data operators: near-dedup, classifiers, archives, decontamination,
quality rules, substring and line dedup, mixing, URL filters.

Nothing else in the library imports this subpackage.  Every operator takes
``DataFrame`` s and returns ``DataFrame`` s; intermediate tables are written
under ``spark.checkpoint.dir`` (``qsig.sources.io.stage``).
"""
