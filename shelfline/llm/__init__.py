"""Training-data operators: de-duplication, scans, classifiers, mixing, sharding."""
