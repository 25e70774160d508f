"""DataFrame -> DataFrame operators on intervals, tracks, annotations and sequences."""
