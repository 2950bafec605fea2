"""ledgerline: weekly sales-revenue reports as PySpark DataFrame jobs.

Entry points:

* ``ledgerline.sources.tables.load_tables(spark, folder)`` - the report inputs;
* ``ledgerline.params.ReportParams`` - report date and bounds;
* ``ledgerline.plans.reports`` / ``ledgerline.plans.jobs`` - the reports and the jobs that write tables;
* ``ledgerline.plans.registry.queries()`` - every report and operator as ``(spark, folder) -> DataFrame``.
"""

__version__ = "0.1.0"
