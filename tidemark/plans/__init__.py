"""Reports and pipelines composed of operators."""
