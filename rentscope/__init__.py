"""rentscope: listing-market analytics expressed as Spark DataFrame jobs.

Layers:
  sources/    landing JSON -> bronze, bronze union-by-name, driver tables
  functions/  column expressions (cleaning, keys, text, fuzzy scoring)
  operators/  reusable DataFrame -> DataFrame operators (windows, aggregates,
              joins, nested data, quality contracts, fuzzy standardization)
  plans/      composed jobs: staging, silver, star schema, market measures,
              and the query registry used by the correctness gate and bench
  streaming/  incremental bronze ingest and snapshot refresh
"""

__version__ = "0.1.0"

# Python code that runs inside tasks (Arrow UDFs, mapInPandas scanners) is
# shipped with the task by value, so executors need no installed copy of this
# package -- the same closure travels to every worker.
try:
    import sys as _sys

    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older pickler: ship the package with --py-files
    pass
