"""Star-schema generation, integrity checks and star-join aggregates as Spark DataFrames."""
