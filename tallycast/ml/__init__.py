"""Training, promotion and scoring with Spark ML."""
