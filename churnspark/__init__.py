"""Customer-churn analytics, scoring, explanation and model monitoring on Spark DataFrames."""
