"""tether: record linkage and entity resolution on Spark DataFrames."""
