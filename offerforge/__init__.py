"""Customer features, propensity scores and eligibility-checked offers as Spark DataFrame operators."""
