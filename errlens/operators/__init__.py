"""DataFrame operators: prep, features, train, score, evaluate, report."""
