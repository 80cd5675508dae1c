"""Operators for preparing training data: quality rules, duplicate removal,
chat formatting, language-model scoring, web archives, source mixing,
benchmark decontamination and personal-data redaction.

Nothing else in the library imports this package. Every operator reads only
the columns it names, so extra columns (also ones that share a name with an
output column) are ignored unless a docstring says that they are kept.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
