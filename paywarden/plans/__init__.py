"""Whole jobs: training, the streaming pipeline, and its SQL surface."""
