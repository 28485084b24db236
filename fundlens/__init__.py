"""fundlens: Spark jobs for crowdfunding and grant-matching data.

Every job is a plain function from DataFrames to a DataFrame built from
built-in column expressions, so Catalyst and AQE choose the physical plan.
"""
