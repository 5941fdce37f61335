"""Table transforms: DataFrame in, DataFrame out, the same for batch and stream."""
