"""symgraph: a PySpark-native engine for building, querying and maintaining a code graph."""
