"""DataFrame operators: labels, sampling, TF-IDF, selection, classifiers, metrics, clusters, search."""
