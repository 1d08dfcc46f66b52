"""Column names shared by all jobs."""

KEY = "customer_unique_id"
TARGET = "target_is_churn"
PREDICTION = "predicted_probability"
