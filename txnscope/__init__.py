"""txnscope: payment-transaction analytics and fraud scoring as Spark jobs.

Sub-packages:
  sources    -- table readers, CSV intake, fixture adapters to the transaction schema
  functions  -- Column-level helpers (labels, safe ratios, time windows, fixed values)
  operators  -- DataFrame -> DataFrame operators (dashboards, profiling, features,
                graph, models)
  plans      -- the query registry used by ``__spark_entry__`` and the DuckDB oracles
  streaming  -- Structured Streaming variants of the "real-time" dashboards
"""

__all__ = ["session"]


def _pickle_by_value() -> None:
    """Ship txnscope's own functions to Python workers by value, so pandas UDFs
    work on executors that do not have the package installed."""
    try:
        import sys

        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # pragma: no cover - older cloudpickle
        pass


_pickle_by_value()
