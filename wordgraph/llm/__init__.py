"""Operators for preparing text corpora to train language models on.

Each module holds one operator and maps DataFrames to DataFrames; ``queries``
registers one query per operator over the given tables. Nothing outside this
package imports it.

Rules common to all operators: only the columns that an operator names are
read, so extra columns never clash; a null text counts as empty unless the
docstring says otherwise; repeated rows are rows of their own; tasks are
retried safely because every random choice is derived from seeds and hashes.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job: the executors need
# not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
