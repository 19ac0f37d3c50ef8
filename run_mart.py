"""``spark-submit run_mart.py --events ... --exports ...``: see ``webmart/plans/job.py``.

The library runs on the driver only (there are no Python UDFs), so executors need no copy of it.
"""

from pyspark.sql import SparkSession

from webmart.plans import job

if __name__ == "__main__":
    job.run(SparkSession.builder.appName("webmart").getOrCreate())
