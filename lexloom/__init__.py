"""Legislative-corpus analytics as Spark jobs.

Everything here is a function over DataFrames: sources and sinks, column
functions, operators, and the plans that chain them.  The session is always
passed in (or taken from the DataFrame) and never created on import.
"""

__version__ = "0.1.0"
