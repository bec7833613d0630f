"""plover: user-behaviour warehousing and profiling as Spark DataFrame jobs.

Every public job is a function DataFrame(s) -> DataFrame. The driver gets
single numbers and per-class or per-bin counts, never rows of the data;
state across days is kept as date-partitioned parquet (see
``plover.sources.io`` and ``plover.plans.daily``).
"""

__version__ = "0.1.0"
