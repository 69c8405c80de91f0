"""corpusforge: Spark-native building, extending and balancing of weakly
labelled headline corpora.

Every operator is a function ``DataFrame -> DataFrame`` (or a ``Column``
expression) built on Spark SQL built-ins; only HTML extraction runs Python
inside tasks (Arrow batches via ``mapInPandas``).
"""

__version__ = "0.1.0"
