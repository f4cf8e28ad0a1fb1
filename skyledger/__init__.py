"""skyledger: cloud-operations analytics as plain DataFrame-in, DataFrame-out Spark operators."""
