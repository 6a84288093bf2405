"""strata: the reference's analytics programs as reusable PySpark operators.

Subpackages: ``sources`` (readers, writers, literal tables), ``functions``
(JVM string rules as Column expressions), ``operators`` (aggregates, merge,
panels, text, links, PageRank, language detection, recommendations),
and ``plans`` (the query catalogue on the driver's tables and its DuckDB oracles).
"""

__version__ = "0.1.0"
