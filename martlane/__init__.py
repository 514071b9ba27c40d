"""martlane: a Spark-native retail analytics engine.

Cleans order / return / territory extracts, checks their quality, builds a
star schema (date, customer, product and people dimensions around an
order-line sales fact) and answers business questions over it.  Every
operator is a function from DataFrames to a DataFrame written with Spark's
own expressions, so Catalyst plans it and the same code runs on a laptop or
a cluster.
"""

__version__ = "0.1.0"
