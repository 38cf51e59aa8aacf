"""Railcadence: public-transport punctuality analytics as plain Spark DataFrame jobs.

Every operator is a ``DataFrame -> DataFrame`` function. Nothing here opens a
connection, starts a server or keeps state outside Spark tables.
"""

__version__ = "0.1.0"
