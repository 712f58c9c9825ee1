"""ledgerloom: a Spark-native engine for tables read off ruled paper forms.

Every operator takes and returns DataFrames; nothing here runs a Spark job at
import time.  The subpackage ``llm`` holds the text operators and is optional:
nothing outside it imports it.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to executors carry their code with them, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
