"""rillflow: alignment, quality control and fidelity studies of multi-stream recordings, as Spark queries."""
