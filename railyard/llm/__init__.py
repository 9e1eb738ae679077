"""Training-data operators on whole corpora, written for Spark.

Each module holds one operator with a general ``DataFrame -> DataFrame``
interface; ``queries`` applies them to the driver's tables.  Nothing else in
the library imports this subpackage.
"""
