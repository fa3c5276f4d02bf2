"""Corpus statistics on Spark: word counts, co-occurrence and TF-IDF over text tables."""

from pyspark import cloudpickle

from wordloom import functions

# The few Python helpers that run inside tasks travel with the query, so executors
# need no installed copy of this package.
cloudpickle.register_pickle_by_value(functions)
