"""quillmill: DataFrame operators for curating scholarly corpora on Spark."""

__version__ = "0.1.0"
