"""Operators for preparing training text: each module is one operator, nothing else imports them.

Functions of this package that run in Python workers are shipped with the task, so the
executors need no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
