"""A Spark-native warehouse for a food-delivery marketplace.

Sources are staged unchanged, resolved into keyed dimensions and facts, and
aggregated into two marts.  Everything except ``sources.store`` is a function
from DataFrames to DataFrames.
"""
