"""tessera: raster-tile analytics as Spark DataFrame jobs.

Every operator is a plain function ``DataFrame -> DataFrame`` (or a
persistable ``pyspark.ml`` Transformer wrapping one). Nothing runs an action
unless its name says so (``write_*``, ``evaluate_*``, ``fit_*``).

Sub-packages:

* ``tessera.sources``    band-file ingest, metadata scans, sinks
* ``tessera.functions``  column-level expressions (paths, indices, arrays)
* ``tessera.operators``  frame-level operators (sampling, labels, tiles,
                         metrics, batching, ML transformers)
* ``tessera.plans``      adapters from the driver's tables and the query set
* ``tessera.streaming``  incremental scoring of arriving tiles
"""

__version__ = "0.1.0"

# Functions shipped to Python workers (Arrow-batched decode, binary stack,
# streaming assembly) are pickled by value, together with the tessera
# helpers they call, so executors need no installed copy of the package.
# A cluster may still ship it with --py-files; both work.
try:  # pragma: no cover - depends on the bundled cloudpickle
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
