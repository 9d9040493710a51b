"""Operators of a large-scale training-data pipeline.

Each module is one operator with its own general interface; ``queries.py``
registers one thin query per operator and ``sql.py`` holds the DuckDB SQL of
those that SQL can express. Nothing else in the library imports this package.

Functions that run in Python workers are pickled by value, so the workers of
a cluster need numpy and pyarrow but not this package.

Common rules for every operator:

* rows with a NULL key (``doc_id``, ``vec_id``) are left out; they have no
  identity to report. (WARC keeps pages with a NULL ``page_id``.)
* NULL text counts as empty text.
* only the columns named in the docstring are read; others, whatever their
  names, are ignored unless an operator says it returns them.
* repeated rows give repeated result rows unless an operator says otherwise.
* an empty table gives an empty result with the same columns.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
