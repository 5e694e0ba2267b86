"""Readers of parcel layers, outlines, code tables and crawled pages."""
