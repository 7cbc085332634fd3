"""Operations of a pipeline for training data, one module each."""
