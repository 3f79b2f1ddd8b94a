"""orderflow: daily work-order analytics for marketing campaigns, as Spark DataFrame jobs.

Layers, lowest first:

* ``functions`` - column expressions (time windows, delimited text, safe numbers)
* ``sources``   - reading areas and snapshots, writing increments and report slices
* ``operators`` - one module per business step, every one DataFrame in, DataFrame out
* ``plans``     - the daily runs composed of those steps
"""

from orderflow.session import configure

__all__ = ["configure"]
