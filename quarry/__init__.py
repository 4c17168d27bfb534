"""quarry: lazy, parameterised PySpark DataFrame operators for tables, text and streams.

Every operator takes DataFrames (and column names / parameters) and returns a lazy
DataFrame; nothing is collected and no session is created inside the library.
"""

__version__ = "0.1.0"
