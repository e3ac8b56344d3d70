"""Issue segmentation and corpus operators on Spark DataFrames."""
