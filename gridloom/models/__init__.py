"""Linear and logistic models, splits and searches."""
