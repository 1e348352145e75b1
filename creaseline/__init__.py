"""Ball-by-ball match analytics on PySpark DataFrames."""
