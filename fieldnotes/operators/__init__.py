"""DataFrame -> DataFrame jobs: one function per model of the pipeline."""
