"""History, loads and marts over periodic snapshots, written as Spark DataFrame functions."""
