"""Compositions of the jobs: the detail ETL, the daily service chain, and
the registered queries over the driver tables with their SQL oracles."""
