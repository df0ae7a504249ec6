"""Jobs that chain the operators: prepare, encode, train, score, report."""
