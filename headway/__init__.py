"""Transit reliability analytics on Apache Spark.

Sub-packages: ``sources`` (timetables, feed snapshots, tables), ``functions``
(column expressions), ``operators`` (DataFrame to DataFrame steps), ``plans``
(whole jobs and reports), ``streaming`` and ``registry`` (the queries that run
on the shared test tables).
"""
