"""Monthly credit-model work on Spark: training sets, learners, scoring and drift monitoring."""
