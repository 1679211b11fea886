"""plinth: a Spark-native engine for tabular regression.

Profiles a labelled table, derives features, drops useless columns, clips,
imputes, scales and encodes, makes reproducible stratified folds,
cross-validates a grid of MLlib models with out-of-fold predictions, blends
them, ranks everything on a leaderboard and writes checked predictions for
the unlabelled rows.  Row work is DataFrame/SQL expressions and
``pyspark.ml`` stages; statistics are exact and distributed by default.
"""

from plinth.spec import Spec, fixture_spec, house_prices_spec  # noqa: F401

__all__ = ["Spec", "fixture_spec", "house_prices_spec"]
