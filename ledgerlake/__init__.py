"""ledgerlake: a PySpark toolkit for card-payment data-lake and warehouse jobs.

Every operator is a function from DataFrame(s) to a DataFrame built on Spark's
own expressions, joins and writers. Clock values and batch ids are arguments,
so reruns give the same rows. Subpackages:

* ``functions`` - column expressions (text quality rules, derived columns)
* ``sources``   - readers (parquet, latest batch, JDBC) and test fixtures
* ``operators`` - row-level transformations (lineage, index, history, SCD2,
  refine, keyed patch)
* ``sinks``     - writers, stage-then-publish, catalog registration
* ``plans``     - the jobs that chain sources, operators and sinks
* ``streaming`` - a Structured Streaming form of the incremental append
* ``oracle``    - DuckDB SQL equivalents of the registered queries (checks)
* ``cli``       - ``spark-submit`` entry points for the jobs
"""

__version__ = "0.1.0"
