"""migratrace: mining recurring incidents across a system migration, on Spark.

Every operator takes DataFrames and returns DataFrames.  Nothing here holds
rows on the driver: driver-side work is column names, rule tables and sizes.
"""
