"""goldkeel - provider and location master data on Spark.

Every public function takes DataFrames and returns DataFrames built from
native Spark expressions; nothing here runs Python per row.
"""
