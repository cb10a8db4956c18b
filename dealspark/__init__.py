"""dealspark: a PySpark-native engine for deal-disclosure records and text corpora."""
