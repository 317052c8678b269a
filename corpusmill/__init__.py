"""corpusmill: text-corpus preparation and personal-data removal on Spark.

Every public function is either ``Column -> Column`` (``corpusmill.functions``)
or ``DataFrame -> DataFrame`` (``corpusmill.operators``).  Nothing is collected
to the driver except a handful of scalars (split boundaries, partition totals,
the chosen merges of one vocabulary round).
"""

__version__ = "0.1.0"
