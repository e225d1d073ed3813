"""cluelake: a PySpark-native engine for event-sourced quiz-show analytics."""

__version__ = "0.1.0"
