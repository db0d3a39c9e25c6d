"""tallyspark: target-versus-actual analytics operators on Spark DataFrames.

Every public operator takes DataFrames (plus plain parameters) and returns a
DataFrame; nothing is collected to the driver on the data path.
"""

__version__ = "0.1.0"
