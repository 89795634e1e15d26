"""Operators for preparing training text at scale.

Nothing else in the library imports this subpackage.  Functions that run in
Python workers are pickled by value, so workers need no copy of the package.
"""

from pyspark import cloudpickle

import docweave.llm as _self

cloudpickle.register_pickle_by_value(_self)
