"""Batch jobs that chain the layers; each stage is gated by its DQ suite."""
