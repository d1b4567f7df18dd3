"""voxscope: public-opinion analytics over post and comment tables, written for Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function or a ``Column -> Column``
function, so that it can be chained with ``df.transform`` and optimised by Catalyst.
"""

__version__ = "0.1.0"
