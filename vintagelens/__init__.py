"""Credit-risk data engine on Spark: datamart stages, training sets, scoring and monitoring."""
