"""kempt: Spark-native cleaning and quality validation for relational tables.

Layers
------
functions   Column builders (text predicates, code points, repairs, casts)
operators   DataFrame -> DataFrame operators (rules, dimension merge, checks,
            profiles, reports)
sources     delimited loads with strict/lenient typing, snapshots (plain and
            bucketed), CSV export
plans       the query catalogue over the driver's tables and its DuckDB oracle
"""

__version__ = "0.1.0"
