"""flowlens: network-flow analytics on Spark, in batch and as a stream."""
