"""Site-observation analytics as PySpark DataFrame operators.

Every operator takes and returns DataFrames (or Columns) and names its key
columns as parameters, so the same code serves any "site x time x metric"
table.  Nothing here starts a session; call :func:`fieldgauge.session.configure`
on the one you have.
"""

__version__ = "0.1.0"
