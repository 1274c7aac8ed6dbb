"""cinerank: ratings analytics and recommendations as Spark DataFrame jobs.

Every operator is a function from DataFrames to a DataFrame. Nothing is
collected to the driver except scalars (row counts) needed to size blocks.
"""

__version__ = "0.1.0"
