"""Training-data operators: fingerprints, joins, packing, filters and classifiers over document tables.

Each module holds one operator with its own general interface; ``queries``
registers the thin ``opN_<name>`` queries over the standard tables.
"""
