"""tessera: customer profile, consent resolution and period comparison as
Spark DataFrame plans.

Layout
------
``sources``    scans and sinks (parquet tables, CSV export) and the SQL that
               derives the warehouse relations the jobs read from the test tables.
``functions``  ``Column -> Column`` helpers (text cleaning, date parsing, flags,
               measures and bands). No UDFs: every helper is a JVM expression.
``operators``  parameterised DataFrame operators (decode, ordered lists,
               latest-per-key, consent gate / exclusion, period join, counts).
``plans``      the composed jobs and the registry of queries with their oracle SQL.
``streaming``  empty on purpose: the jobs are bounded batch jobs.
"""

__all__ = ["sources", "functions", "operators", "plans"]
