"""cartolex: text and graph records to an educational knowledge graph, on Spark DataFrames."""
