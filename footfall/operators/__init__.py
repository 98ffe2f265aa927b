"""DataFrame -> DataFrame operators of the feature pipeline."""
