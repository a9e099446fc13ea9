"""Operators for preparing training text at scale.

Every module holds one operator with a general interface plus the thin query
that applies it to the test tables. Functions that run inside tasks are shipped
by value, so executors need numpy, pyarrow, xxhash and zstandard, but not this
package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
