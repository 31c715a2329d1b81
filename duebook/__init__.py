"""duebook: open item and balance lists for billing data, planned by Spark.

Every step is a plain function from DataFrames to a DataFrame.  See the README
for the layout and for how the steps behave on large, skewed inputs.
"""
