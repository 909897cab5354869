"""Training-data pipeline operators (documents and pages in, decisions out).

Every operator takes DataFrames from the caller and returns a DataFrame; each
module's docstring states its result for nulls, empty and very long texts,
ties, repeated rows, empty tables and extra columns.  ``queries`` binds them
to the driver's tables.  Nothing outside this package imports it.
"""

import sys

from pyspark import cloudpickle

# tasks carry the functions of this package with them, so executors need no
# installed copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
