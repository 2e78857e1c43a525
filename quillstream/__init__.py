"""quillstream: Spark-native news ingestion and enrichment.

Every step of the pipeline (feed window scan, link unwrapping, page text
extraction, model request/response handling, strict answer parsing,
deduplication, id allocation, merges and streaming ingest) is a DataFrame
job.  Per-row logic is expressed with built-in column functions so it runs
inside whole-stage codegen; the only Python hop is the pluggable model
scorer (``operators.scoring``), which runs batched through ``mapInPandas``.
"""

import sys as _sys

from quillstream.session import get_session, scratch_path  # noqa: F401


def _pickle_by_value() -> None:
    """Python tasks (the scorer, text scans) must not need this package
    installed on executors: pickle its functions by value instead of by
    module reference."""
    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(_sys.modules[__name__])
    except Exception:  # noqa: BLE001 - older cloudpickle: package must be installed
        pass


_pickle_by_value()

__all__ = ["get_session", "scratch_path"]
