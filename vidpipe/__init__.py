"""Search-hit, video and channel tables as Spark DataFrames: parsing, validation, merging, planning of work."""
