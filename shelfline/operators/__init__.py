"""DataFrame -> DataFrame operators of the pipeline."""
