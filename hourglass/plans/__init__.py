"""Report pipelines built from the operators."""
