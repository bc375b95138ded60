"""kinelake: episode analytics on Spark DataFrames."""
