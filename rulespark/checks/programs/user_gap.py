from pyspark.sql import Window
from pyspark.sql import functions as F

# Two events more than a day apart are never on one day, so only a day's first event can
# follow a gap. A user's days are few even where the user's events are not.
days = dataframes["events"].groupBy("user_id", F.to_date("ts").alias("day")).agg(
    F.min(F.struct("ts", "event_id")).alias("first"), F.max("ts").alias("last")
)
by_user = Window.partitionBy("user_id").orderBy("day")
days = days.withColumn("prev", F.lag("last").over(by_user))
result_df = days.where(F.col("first.ts") > F.col("prev") + F.expr("INTERVAL 1 DAY")).select(
    F.lit("user|gap").alias("HEADER_DATA"),
    F.col("user_id").cast("string").alias("COL1"),
    F.col("first.event_id").cast("string").alias("COL2"),
    F.lit("").alias("COL3"),
)
