"""Graph and frequency operators: DataFrame in, DataFrame out, nothing run."""
