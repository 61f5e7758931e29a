"""winnow: corpus curation operators on Spark DataFrames.

Every operator takes and returns DataFrames.  The heavy work (shingling,
signatures, LSH buckets, clustering, statistics, metrics) runs as Spark
joins, aggregations and windows; Python appears only as small Arrow UDF
helpers where Spark SQL has no built-in (NFKC, md5-minhash, LCS).
"""

import sys as _sys

# Python workers may not have this package on their path (a cluster, or a
# driver started from another folder): pickle its functions -- the Arrow
# helpers and mapInPandas bodies -- by value, so executors need nothing
# installed beyond pyspark, numpy and pyarrow.
try:
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: rely on the import path
    pass

from winnow.session import get_session, checkpoint_dir, table  # noqa: E402

__all__ = ["get_session", "checkpoint_dir", "table"]
