"""Training-data pipeline operators (near-dedup, quality, PII, chat, decontamination, mixing, HTML).

One module per operator; ``queries`` holds the registered queries and their SQL.
Nothing outside this package (but ``corpus_pipeline.py``) imports it.
"""

import sys

from pyspark import cloudpickle

# functions of this package travel with the tasks: executors need no copy of the repository
cloudpickle.register_pickle_by_value(sys.modules[__name__])
