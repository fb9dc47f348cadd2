"""aprisco - a layered dimensional warehouse toolkit written on Spark DataFrames."""
