"""Retail, event-time and data-quality analytics written on Spark DataFrames.

The sub-packages:

* ``sources``   - scans, sinks, streams, generated test data
* ``functions`` - column expressions (text, time, numbers)
* ``operators`` - DataFrame to DataFrame operators
* ``streaming`` - Structured Streaming jobs and the runner that drives them
* ``plans``     - the registered queries, each with the SQL that checks it
"""

__version__ = "0.1.0"
