"""Streaming.

The reference pipeline has no streaming part: every source is a one-shot scan of a document
collection. ``landing`` shows the one place where a stream fits the same code: new landing
documents picked up incrementally and formatted with the batch operators per micro-batch.
"""
