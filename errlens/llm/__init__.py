"""Operations of a large training-data pipeline, each a Spark job."""
