"""daybook: daily loan-portfolio reporting on Spark.

The package rebuilds a daily regulatory snapshot report (joins of orders,
borrowers, status history, instalment bills and extensions, plus the derived
risk columns) and the table jobs around it, as DataFrame / SQL plans.

Layout
------
``sources``    readers: driver tables, the loan model, snapshots, partner files,
               config, JDBC, bulk text.
``functions``  Column builders: loan rules, dates, export quoting, typed decoding
               of text, column protection.
``operators``  relational building blocks: joins, filters, aggregates, counter,
               manifests, query surface.
``plans``      end-to-end jobs: ``build_report``, snapshot replace / export,
               result check.
``streaming``  intentionally empty (the reporting job is a batch job).
"""

from daybook.params import ReportParams

__all__ = ["ReportParams"]
