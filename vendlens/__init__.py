"""vendlens: revenue and customer analytics for marketplaces, on PySpark DataFrames.

raw tables -> star schema -> marts -> data quality, headline metrics, findings
and chart datasets.  Every step is a function from DataFrames to a DataFrame.
"""
