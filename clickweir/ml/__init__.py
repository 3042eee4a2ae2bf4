"""Features, training, evaluation and scoring with Spark ML."""
