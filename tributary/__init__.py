"""tributary: record fusion and faceted analytics over sparse, string-valued tables, as Spark DataFrames."""
