"""bankmart: a Spark-native bronze -> silver -> gold library for retail-banking feeds.

Layers
------
sources/    raw CSV feeds (all-STRING bronze), lake paths and sinks
functions/  row-local cleaning rules and exact gold arithmetic (Columns)
operators/  DataFrame -> DataFrame operators: keep-first dedupe, exact
            median fill, value-list rejection, profiles
plans/      the four silver jobs, three marts, six business queries and
            the bronze / silver data-quality checks
llm/        operators of training-data pipelines (removable; nothing here imports it)
"""

__version__ = "0.1.0"
