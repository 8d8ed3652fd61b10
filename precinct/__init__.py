"""Incident analytics as lazy Spark DataFrame operators.

Sub-packages:

* ``sources``   - readers, writers and the mapping of the star-schema tables to incidents and runs
* ``functions`` - column expressions (dates, hours, labels, report text)
* ``operators`` - DataFrame to DataFrame steps (cleaning, counts, splits, metrics, models, reports)
* ``plans``     - whole jobs built from the operators, the query registry and its oracle SQL
"""

__version__ = "0.1.0"
