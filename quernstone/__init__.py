"""quernstone: a PySpark-native curation engine for question banks, lessons and document pages."""

__version__ = "0.1.0"
