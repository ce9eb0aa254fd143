"""postings_lake: Spark-native curation and analytics for job-postings data.

Subpackages
-----------
functions   Column factories (taxonomy tagging, seniority, dates, text).
operators   DataFrame -> DataFrame operators (dedupe, curate, marts, gate, explore).
sources     Landed pages, table layout, writes with observed counts.
streaming   Incremental ingest of landed page files into bronze.
plans       Multi-step flows, fixture adapters, query registry and oracles.

Every operator runs on the caller's SparkSession, sets no session config and
never collects row data to the driver.
"""
__version__ = "0.1.0"
