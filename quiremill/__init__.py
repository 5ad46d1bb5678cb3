"""quiremill: a PySpark-native document-evidence engine."""
