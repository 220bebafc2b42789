"""Retail demand analytics expressed as Spark DataFrame and MLlib jobs.

Layers, from the bottom up:

* ``functions``  column expressions (money, dates, text)
* ``sources``    table contracts, scans and sinks
* ``operators``  DataFrame -> DataFrame steps, one module per family
* ``plans``      whole jobs that read stage tables, call operators and write
"""

from shelfcast.schema import TxColumns

__all__ = ["TxColumns"]
