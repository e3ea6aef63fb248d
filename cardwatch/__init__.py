"""cardwatch: a Spark-native card-operations warehouse and fraud report.

Every operator is a function from DataFrames to a DataFrame, so the whole
daily load is one lazily planned Spark job per written table.  Modules:

* ``functions``  column helpers for the SQL dialect the warehouse mirrors
* ``sources``    feed readers, driver test tables, the snapshot store
* ``operators``  extract, SCD2, facts, joins, the four fraud rules
* ``plans``      the fraud report, the daily run, the query catalog
* ``streaming``  file-feed intake with Structured Streaming
"""

from cardwatch.schemas import OPEN_END, BEGINNING, EventType  # noqa: F401
