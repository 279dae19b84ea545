"""Spark-native analytics over spliced alignments, transcripts, variants and other interval tables."""
