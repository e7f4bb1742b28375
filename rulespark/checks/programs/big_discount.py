from pyspark.sql import functions as F

line = dataframes["lineitem"].where((F.col("l_discount") > 0.095) & (F.col("l_quantity") >= 45))
result_df = line.select(
    F.lit("line|discount").alias("HEADER_DATA"),
    F.col("l_orderkey").cast("string").alias("COL1"),
    F.col("l_linenumber").cast("string").alias("COL2"),
    F.col("l_discount").cast("decimal(18,2)").cast("string").alias("COL3"),
)
