"""tallylake: order, payment and customer analytics as Spark DataFrame functions.

Every public function takes DataFrames (or a SparkSession and a path) and returns a DataFrame. Nothing here
creates, configures or stops a session.
"""
