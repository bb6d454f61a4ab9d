"""wordmill: corpus preparation, vocabularies, training windows, matrix
algebra, batch scoring, decoding and data-parallel training as Spark jobs."""

__version__ = "0.1.0"
