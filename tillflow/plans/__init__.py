"""Whole jobs: the pipelines, history queries, publishing, compaction."""
