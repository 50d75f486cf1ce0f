"""quirebind: document corpora to validated, navigable bundles, on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function (usable with
``df.transform``), so the same code runs on a batch table and inside a
Structured Streaming micro-batch.
"""

__version__ = "0.1.0"
