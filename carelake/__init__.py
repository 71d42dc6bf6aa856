"""carelake: claims-to-OMOP table builds expressed as Spark DataFrame plans.

Layout
------
- ``functions``  Column -> Column expressions (keys, dates, codes).
- ``sources``    readers for raw CSV deliveries and parquet tables, schema helpers.
- ``operators``  DataFrame -> DataFrame building blocks (unions, dedupes,
                 latest-record picks, size-checked lookups, sums).
- ``plans``      the raw-claims load, the 14 OMOP table builds, integrity checks,
                 and the ordered build of all tables.
- ``sinks``      distributed writers.
- ``streaming``  incremental form of the load for delivery folders.
- ``testbed``    stand-in claims tables derived from the driver's test tables.

Every builder is a pure function of DataFrames that collects nothing (with ``hot_rows`` it
asks for a bounded list of keys).  The load collects one row per table or year.
"""

__version__ = "0.1.0"
