"""Mining a gene-expression archive with Spark DataFrames."""
