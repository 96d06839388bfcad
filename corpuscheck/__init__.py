"""corpuscheck: document-corpus checks on Spark.

Ingest and deduplicate text files, count paragraphs / words / bytes,
normalise text, find exact and near-duplicate documents with an exact n-gram
Jaccard similarity join, and keep a plagiarism report up to date in batch or
as a stream. Every operator is a DataFrame -> DataFrame function built from
Spark SQL expressions.
"""

__version__ = "0.1.0"
