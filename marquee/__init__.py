"""marquee: user / movie / rating / tag analytics as Spark DataFrame functions.

Layout:

* ``sources``   - raw CSV / Parquet scans, the adapter from the driver's tables, sinks
* ``functions`` - reusable Column expressions (dates, years, genres, rounding, bins)
* ``operators`` - one pure ``DataFrame -> DataFrame`` function per query
* ``plans``     - table bundles, lineage cuts, the summary report, the query registry
* ``streaming`` - the same sources and cleaning on a Structured Streaming input
"""

from marquee.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
