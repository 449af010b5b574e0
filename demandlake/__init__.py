"""demandlake: Spark-native ingestion of search-demand report exports.

Every public function is either ``Column -> Column`` (``demandlake.functions``)
or ``DataFrame -> DataFrame`` (``demandlake.operators``).  None of them reads a
clock: ``today`` and ``now`` are always arguments.
"""

__version__ = "0.1.0"
