"""Table operators: DataFrame in, DataFrame out."""
