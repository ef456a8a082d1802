"""weftgraph: collaboration-graph analytics on Spark DataFrames."""
