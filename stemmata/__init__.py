"""PySpark-native engine for corpora of marked-up text."""
