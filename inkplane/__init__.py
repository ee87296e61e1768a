"""inkplane: Spark-native analytics over text regions of large scanned drawings."""
