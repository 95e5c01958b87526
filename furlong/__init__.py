"""furlong: a medallion data toolkit for racing and retail data, built on PySpark.

Layout
    functions   Column functions: money, keys, parsing, dates, the type gate
    operators   DataFrame -> DataFrame building blocks: ranking, keyed dedup, checks
    sources     landed JSON, Bronze NDJSON, seeds, catalog tables, keyed sinks, audit
    plans       whole jobs: shop models, race history, Bronze and Silver steps
    streaming   incremental versions of ingest, dedup, gate and keyed insert
    registry    the queries and reference SQL that the driver runs side by side
"""

__version__ = "0.1.0"
