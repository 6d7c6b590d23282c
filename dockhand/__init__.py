"""Document intake, masking, enrichment and product-data queries on Spark.

Every operator is a plain function from DataFrame to DataFrame (or Column to
Column); nothing here runs a job unless its docstring says so.
"""
