"""Retail feed preparation on Spark DataFrames.

``functions`` are Column expressions, ``sources`` read and publish files,
``operators`` map DataFrames to DataFrames, ``plans`` put them together into
the feeds a retailer delivers (stores, products, prices, stock, inbound, sales).
"""
