"""Model families on ``pyspark.ml`` (design matrix, linear, trees, t-loss boosting, KNN,
kernel approximations, LDA) and feature importances."""
