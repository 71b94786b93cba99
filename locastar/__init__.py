"""locastar: a PySpark-native warehouse for a consortium of car-rental fleets.

Layers (all plain DataFrame transformations, no Python UDFs):

* ``sources``   -- readers for the input tables and the per-fleet mapping configs
* ``functions`` -- Column -> Column helpers (text, domain maps, dates, money, quality)
* ``operators`` -- DataFrame -> DataFrame building blocks (conform, merge, keys,
                   dimension/fact load, snapshots, lookups, audits)
* ``plans``     -- the warehouse build, the analytical marts and the nightly job
* ``streaming`` -- the change-data feed applied with Structured Streaming
"""

__version__ = "0.1.0"
