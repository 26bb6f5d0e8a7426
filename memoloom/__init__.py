"""memoloom: a Spark-first engine that turns short review texts into a versioned taxonomy dataset."""
