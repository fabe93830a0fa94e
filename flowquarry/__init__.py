"""Network-flow enrichment and forensics on Spark DataFrames."""
