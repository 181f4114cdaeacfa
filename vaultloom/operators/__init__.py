"""Table operators: DataFrame in, DataFrame out. None of them runs an action."""
