"""Operators on recordings, stacks and stimuli: DataFrame in, DataFrame out."""
